"""Exact and near duplicates against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_packed import plain_shingles
from tierlake.llm import near_dedup
from tierlake.llm.common import packed
from tierlake.llm.components import components
from tierlake.llm.exact_dedup import drop_copies, exact_groups
from tierlake.llm.common import shingles
from tierlake.llm.near_dedup import CELL_BITS, COMMON, _cells, block_values, common_columns, drop_near_copies, link_rows, near_groups, need


def plain_groups(docs):
    by_text = defaultdict(list)
    for key, text in docs:
        by_text[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append(key)
    out = []
    for text, keys in by_text.items():
        known = [k for k in keys if k is not None]
        for key in keys:
            keep = (min(known) if known else None) if len(keys) > 1 else key
            out.append((key, hashlib.sha256(text.encode()).hexdigest(), keep, len(keys)))
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"fingerprint_bits": 3, "owners": 2, "sender_rows": 2, "filter_bits": 64}])
def test_exact_groups(odd_docs, odd_rows, options):
    found = exact_groups(odd_docs, **options).select("row_id", F.lower(F.hex("digest")).alias("d"), "keep_id", "group_size")
    assert sorted(map(tuple, found.collect()), key=str) == plain_groups([r[:2] for r in odd_rows])


def test_groups_survive_a_weak_digest(odd_docs, odd_rows):
    weak = F.substring(F.unhex(F.lpad(F.hex(F.octet_length("body")), 16, "0")), 1, 8)
    found = exact_groups(odd_docs, digest=weak).select("row_id", "keep_id", "group_size")
    assert sorted(map(tuple, found.collect()), key=str) == sorted([(k, g, n) for k, _, g, n in plain_groups([r[:2] for r in odd_rows])], key=str)


def test_empty_tables(no_docs):
    assert exact_groups(no_docs).collect() == [] and drop_copies(no_docs).collect() == []
    assert near_groups(no_docs).collect() == [] and drop_near_copies(no_docs).collect() == []


def test_copies_are_dropped_and_columns_kept(odd_docs):
    kept = drop_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 3, 4, 6, 7, 8, 9, None, 11, 12]))


CLASHING = "doc_id long, text string, __own long, __row string, __keep string, __at long, __bits long, row string, own string, named string, key string"


def test_stages_judge_rows_and_not_keys(spark):
    """A key that repeats with another text, near copies without a key, and columns named like helpers."""
    long_text = " ".join("w{}".format(n) for n in range(60))

    def kept(drop, rows):
        frame = spark.createDataFrame([(*r, 1, "x", "y", 2, 3, "z", "p", "q", "s") for r in rows], CLASHING)
        result = drop(frame)
        assert result.columns == frame.columns
        return sorted(((r["doc_id"], r["text"]) for r in result.collect()), key=str)

    assert kept(drop_copies, [(1, "A x"), (5, "A x"), (5, "B y")]) == [(1, "A x"), (5, "B y")]
    assert kept(drop_copies, [(None, "A x"), (None, "A  x"), (5, "B y"), (None, "B y"), (5, "B y")])[0] == (5, "B y")
    assert len(kept(drop_copies, [(None, "A x"), (None, "A  x"), (5, "B y"), (None, "B y"), (5, "B y")])) == 2
    rows = [(1, long_text), (5, long_text + " z"), (5, "a text of its own with many more words than five")]
    assert kept(drop_near_copies, rows) == [rows[0], rows[2]]
    rows = [(None, long_text), (None, long_text + " z"), (None, None), (None, ""), (7, None)]
    found = kept(drop_near_copies, rows)
    assert len(found) == 4 and sum(t in (long_text, long_text + " z") for _, t in found) == 1
    rows = [(9, long_text), (None, long_text + " z"), (4, "other"), (4, "words")]
    assert kept(drop_near_copies, rows) == sorted([rows[0], rows[2], rows[3]], key=str)


def plain_components(docs, size, percent):
    sets = {k: set(plain_shingles(t, size)) for k, t in docs if k is not None}
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {(k, len(sets[k]), find(k)) for k in keys}


def test_odd_documents_near(odd_docs, odd_rows):
    found = near_groups(odd_docs, words=4, percent=85)
    assert len(found.collect()) == len(odd_rows)
    assert {tuple(r) for r in found.filter("row_id is not null").collect()} == plain_components([r[:2] for r in odd_rows], 4, 85)
    assert {r["component_id"] for r in found.filter("row_id is null").collect()} == {None}


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at : at + rng.randrange(2)] = [str(rng.randrange(10**6))] * rng.randrange(3)
    return words


@pytest.fixture(scope="module")
def near_corpus():
    """Groups of edited copies near the bound, a passage that all share, short texts and exact copies."""
    rng = random.Random(7)
    passage = ["p{}".format(i) for i in range(40)]
    docs = []
    for group in range(14):
        base = ["g{}w{}".format(group, i) for i in range(rng.choice([5, 12, 30, 120, 300]))]
        for _ in range(rng.choice([1, 3, 25])):
            words = edited(rng, base, rng.randrange(0, max(2, len(base) // 20)))
            docs.append((len(docs), " ".join(words + (passage if rng.random() < 0.4 else []))))
    return docs


@pytest.mark.parametrize(
    ("words", "percent", "options"), [
        (4, 85, {}),
        (5, 80, {"tile_shingles": 600, "send_shingles": 300, "owners": 3, "filter_bits": 64}),
        (5, 80, {"send_shingles": 300, "owners": 40, "table_bits": 10}),
    ],
)
def test_components_equal_brute_force(spark, near_corpus, words, percent, options):
    frame = spark.createDataFrame(near_corpus, "doc_id long, text string").repartition(5)
    found = {tuple(r) for r in near_groups(frame, words=words, percent=percent, **options).collect()}
    expected = plain_components(near_corpus, words, percent)
    assert found == expected
    assert 20 < sum(k != root for k, _, root in expected) < len(near_corpus) - 20


def test_linked_sets_meet_on_a_column_block():
    rng = np.random.default_rng(3)
    met = 0
    for percent in (80, 85):
        for size in [*range(1, 60), 200, 997, 4000]:
            for _ in range(4):
                a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
                drop = int(rng.integers(0, size // 6 + 2))
                b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**64, int(rng.integers(0, size // 6 + 2)), dtype=np.uint64)]))
                shared = np.intersect1d(a, b).size
                if not b.size or shared < need(a.size, b.size, percent):
                    continue
                sizes = np.array([a.size, b.size])
                row, value = block_values(np.repeat([0, 1], sizes), np.concatenate([a, b]), sizes, percent)
                assert np.intersect1d(value[row == 0], value[row == 1]).size
                met += 1
    assert met > 100


def test_common_columns_are_counted_over_all_texts(spark):
    texts = ["x{} y{} ".format(i // 2, i // 2) + ("p q r s t" if i % 3 else "") for i in range(90)] + [None, "", " "]
    frame = spark.createDataFrame([(t,) for t in texts], "body string").repartition(6)
    counts = Counter(g for t in texts for g in set(plain_shingles(t, 2)))
    hashed = {}
    for gram in counts:
        data = " ".join(gram).encode() if isinstance(gram, tuple) else gram.encode()
        _, value = shingles(np.array([0, len(data)]), np.frombuffer(data, dtype=np.uint8), 2)
        hashed[gram] = value
    for owners, limit in ((1, 7), (500, 1 << 20)):
        tables = dict(common_columns(frame, 2, owners, limit, 24))
        assert set(tables) == {n for n in COMMON if n <= max(counts.values())}
        for gram, value in hashed.items():
            for least, bits in tables.items():
                at = int(_cells(value)[0]) >> (CELL_BITS - (bits.size * 8).bit_length() + 1)
                marked = bool(bits[at >> 3] >> (at & 7) & 1)
                assert marked or counts[gram] < least
        assert all(8 * b.size >= 8 * sum(c >= n for c in counts.values()) for n, b in tables.items())
    few = common_columns(frame, 2, 1, 1 << 20, 8)
    assert few and few[0][0] > 2 and all(8 * bits.size <= 1 << 8 for _, bits in few)


def test_product_links_are_complete():
    rng = random.Random(5)
    for _ in range(40):
        sets = [sorted(rng.sample(range(30), rng.randrange(1, 20))) for _ in range(12)]
        sets += [sorted(set(s[1:] + [rng.randrange(30)])) for s in sets[:6]]
        sizes = np.array([len(s) for s in sets])
        links = link_rows(sizes, np.repeat(np.arange(len(sets)), sizes), np.array([v for s in sets for v in s], dtype=np.uint64), 70)
        root = list(range(len(sets)))
        for a, b in links:
            shared = len(set(sets[a]) & set(sets[b]))
            assert 100 * shared >= 70 * (len(sets[a]) + len(sets[b]) - shared)
            root = [root[a] if r == root[b] else r for r in root]
        for a in range(len(sets)):
            for b in range(a):
                shared = len(set(sets[a]) & set(sets[b]))
                if 100 * shared >= 70 * (len(sets[a]) + len(sets[b]) - shared):
                    assert root[a] == root[b]


def test_one_of_each_near_group_stays(spark, near_corpus):
    frame = spark.createDataFrame([(k, t, "x") for k, t in near_corpus], "doc_id long, text string, row_id string")
    kept = sorted(tuple(r) for r in drop_near_copies(frame).select("doc_id").collect())
    assert kept == [(k,) for k in sorted({root for _, _, root in plain_components(near_corpus, 5, 80)})]


def test_components_of_a_long_path_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (200, 150)]
    found = {tuple(r) for r in components(spark.createDataFrame(pairs, "a long, b long")).select("node", "root").collect()}
    assert found == {(i, 0) for i in range(1, 61)} | {(100 + i, 100) for i in range(1, 50)} | {(200, 150)}


@pytest.fixture(scope="module")
def chance_corpus():
    """Every document shares a rare passage with the next one; nine have up to nine near copies."""
    rng = random.Random(11)
    words = [["d{}w{}".format(i, j) for j in range(40)] + ["c{}w{}".format(k, j) for k in (i, i + 1) for j in range(7)] for i in range(200)]
    docs = [(i, " ".join(w)) for i, w in enumerate(words)]
    for size in range(2, 11):
        docs += [(1000 * size + i, " ".join(edited(rng, words[size], 1))) for i in range(size - 1)]
    return docs


@pytest.fixture
def stored(monkeypatch):
    """Rows that near_dedup stages, by label."""
    rows = Counter()
    stage = near_dedup.stage

    def counted(frame, label):
        found = stage(frame, label)
        rows[label] += found.count()
        return found

    monkeypatch.setattr(near_dedup, "stage", counted)
    return rows


def test_columns_shared_by_chance_connect_nothing(spark, chance_corpus, stored):
    """No table says which columns occur once, as over many documents."""
    frame = spark.createDataFrame(chance_corpus, "doc_id long, text string").repartition(4)
    found = {tuple(r) for r in near_groups(frame, table_bits=7).collect()}
    assert found == plain_components(chance_corpus, 5, 80)
    assert sum(root != k for k, _, root in found) > 30
    assert stored["sets"] < 100


def test_the_stage_stores_few_sets_of_columns_shared_by_chance(spark, chance_corpus, stored):
    frame = spark.createDataFrame(chance_corpus, "doc_id long, text string").repartition(4)
    kept = sorted(r["doc_id"] for r in drop_near_copies(frame, table_bits=7).collect())
    assert kept == sorted({root for _, _, root in plain_components(chance_corpus, 5, 80)})
    assert stored["sets"] < 100


def test_sketches_differ_in_no_more_bits_than_rows_in_columns():
    rng = np.random.default_rng(2)
    pairs = []
    for size in (0, 1, 3, 64, 65, 500, 513, 3000, 40_000):
        a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
        for new in (0, size // 10, size):
            pairs.append((a, np.unique(np.concatenate([a[new:], rng.integers(0, 2**64, new + 1, dtype=np.uint64)]))))

    def sketched(rows):
        content, bounds = near_dedup.sketches(np.concatenate(rows), np.array([r.size for r in rows]))
        return packed(content, bounds)

    found = near_dedup.differing(sketched([a for a, _ in pairs]), sketched([b for _, b in pairs])).tolist()
    for (a, b), bits in zip(pairs, found, strict=True):
        assert bits <= np.setxor1d(a, b).size
        if 500 <= a.size < 2 * near_dedup.SKETCH_BITS and not np.intersect1d(a, b).size:
            assert bits > a.size + b.size - 2 * need(a.size, b.size, 80)
