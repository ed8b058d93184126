"""Benchmark windows in documents against brute force, with shuffled and broadcast grams."""

from __future__ import annotations

import random
import re

import pytest

from tierlake.llm.decontaminate import benchmark_hits, drop_contaminated

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def plain_hits(docs, items, window=10):
    windows = {}
    for key, text in items:
        own = words(text)
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            windows.setdefault(tuple(own[i : i + size]), set()).add(key)
    out = []
    for key, text in docs:
        own, hit, held = words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(own) - size + 1):
                if tuple(own[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    held |= windows[tuple(own[i : i + size])]
        out.append((key, len(own), len(hit), tuple(sorted(str(k) for k in held if k is not None))))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(3)
    some = lambda n, k=12: " ".join("ab cd ef gh ij kl mn op qr st uv wx".split()[rng.randrange(k)] for _ in range(n))
    items = [(i, some(rng.choice([12, 25]))) for i in range(8)]
    items += [(20, "Short item é"), (21, "x"), (22, ""), (23, None), (None, "no key but eight words here to find"), (24, items[0][1]), (25, "ab " * 14)]
    docs = [(i, some(rng.randrange(60))) for i in range(40)]
    for i in range(40, 90):
        text = items[rng.randrange(len(items))][1] or ""
        docs.append((i, "{}, {}! {}".format(some(rng.randrange(30)), text.upper() if i % 3 else text, some(rng.randrange(30)))))
    docs += [(90, None), (91, ""), (92, "ab " * 40), (93, items[0][1]), (93, items[0][1]), (None, items[1][1]), (None, "clean"), (94, "É é Short-item-é"), (95, "short item É")]
    return docs, items


@pytest.mark.parametrize("options", [{}, {"broadcast_grams": 0, "gram": 3, "filter_bits": 64}, {"gram": 1}])
def test_hits_equal_brute_force(spark, case, options):
    docs, items = case
    frame = spark.createDataFrame([(k, t, "x", "y") for k, t in docs], "doc_id long, text string, words string, place string").repartition(3)
    bench = spark.createDataFrame([(k, t, "x") for k, t in items], "item_id long, text string, items string")
    found = sorted(((r["row_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in benchmark_hits(frame, bench, **options).collect()), key=str)
    expected = plain_hits(docs, items)
    assert found == expected and 20 < sum(n > 0 for _, _, n, _ in expected) < len(expected)


def test_contaminated_documents_go(spark, case):
    docs, items = case
    frame = spark.createDataFrame([(k, t, "x") for k, t in docs if k is not None], "doc_id long, text string, found string")
    kept = drop_contaminated(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k for k, _, n, _ in plain_hits(docs, items) if k is not None and not n)


@pytest.mark.parametrize("options", [{}, {"broadcast_grams": 0, "filter_bits": 64}])
def test_clean_documents_stay_whatever_their_key(spark, case, options):
    docs, items = case
    docs = docs + [(None, None), (None, "clean"), (93, "another text of key 93"), (-(2**63), "smallest key"), (-(2**63), items[0][1])]
    frame = spark.createDataFrame([(k, t, "x") for k, t in docs], "doc_id long, text string, found string").repartition(3)
    kept = drop_contaminated(frame, spark.createDataFrame(items, "item_id long, text string"), **options)
    wanted = [(k, t) for k, t in docs if not plain_hits([(k, t)], items)[0][2]]
    assert {(None, "clean"), (93, "another text of key 93"), (-(2**63), "smallest key")} <= set(wanted)
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(wanted, key=str)


def test_empty_tables(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert benchmark_hits(no_docs, none).collect() == []
    assert {(r["n_hit"], tuple(r["items"])) for r in benchmark_hits(odd_docs, none).collect()} == {(0, ())}
    assert drop_contaminated(odd_docs, none).count() == odd_docs.count()
