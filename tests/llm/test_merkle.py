from __future__ import annotations

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tierlake.llm.merkle import fold, proofs, regenerate, runs, siblings, verify

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return sha256(text.encode()).hexdigest()


def plain_leaf(values):
    return sha("".join("-" if v is None else "{}:{}".format(len(str(v).encode()), v) for v in values))


def plain_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][n : n + 3])) for n in range(0, len(levels[-1]), 3)])
    return levels


def plain_way(levels, place):
    for level in levels[:-1]:
        first = place - place % 3
        run = level[first : first + 3]
        yield run[: place % 3], run[place % 3 + 1 :]
        place //= 3


def plain_proofs(rows):
    """(key, leaf, subroot, root, proof, folded, verified) of every row; altered texts lose their line ends."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        inside = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[name] = inside, plain_levels([plain_leaf(r) for r in inside])
    tops = plain_levels([trees[name][1][-1][0] for name in names])
    for at, name in enumerate(names):
        inside, levels = trees[name]
        for place, row in enumerate(inside):
            way = [*plain_way(levels, place), *plain_way(tops, at)]
            folded = plain_leaf((*row[:4], row[4] if row[4] is None else row[4].replace("\n", "")))
            for before, behind in way:
                folded = sha("".join([*before, folded, *behind]))
            proof = sha("".join("".join([*before, *behind]) for before, behind in way))
            root = tops[-1][0]
            yield row[0], levels[0][place], levels[-1][0], root, proof, folded, folded == root


def found(frame, stride):
    checked = verify(proofs(frame, "doc_id", "source", FIELDS, F.translate("text", "\n", ""), stride))
    names = ("leaf", "subroot", "root", "proof", "folded")
    shown = checked.select("row_id", *[F.lower(F.hex(name)) for name in names], "verified")
    return sorted(map(tuple, shown.collect()), key=str)


@pytest.mark.parametrize("stride", [1, 2, 3])
def test_proofs_of_odd_rows_equal_plain_trees(spark, odd_docs, odd_rows, stride):
    rows = [(r[0], r[3], r[2], r[4], r[1]) for r in odd_rows]
    assert found(odd_docs, stride) == sorted(plain_proofs(rows), key=str)


def test_one_large_group_and_many_small_ones(spark):
    rows = [(n, "hot", "en", n, "line\nline" if n % 3 else "line") for n in range(700)]
    rows += [(n % 50, "s{}".format(n % 41), None, None, "t") for n in range(200)] + [(None, "hot", None, None, None)] * 90
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    assert found(frame, 3) == sorted(plain_proofs(rows), key=str)


def test_a_single_row_and_no_row(spark, no_docs):
    frame = spark.createDataFrame([(1, "a", "en", 1, "x")], "doc_id long, source string, lang string, n_chars long, text string")
    ((key, leaf, subroot, root, proof, folded, verified),) = found(frame, 3)
    assert leaf == subroot == root == folded == plain_leaf((1, "a", "en", 1, "x")) and proof == sha("") and verified
    assert found(no_docs, 3) == []


def test_regenerated_levels_stop_where_the_tree_does():
    stored = [bytes([n]) * 32 for n in range(27)]
    assert [len(level) for level in regenerate(stored, 27, 3)] == [27, 9, 3, 1]
    assert [len(level) for level in regenerate(stored[:2], 200, 3)] == [2, 1, 1, 1]
    assert [len(level) for level in regenerate(stored[:1], 1, 3)] == [1]
    levels = regenerate(stored[:5], 5, 3)
    for place, leaf in enumerate(levels[0]):
        assert fold(leaf, siblings(levels, place)) == levels[-1][0]
        assert fold(b"\xff" * 32, siblings(levels, place)) != levels[-1][0]
    assert [len(others) for _, others in runs(siblings(levels, 4))] == [1, 1]
