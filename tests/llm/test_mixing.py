"""Temperature mixing: limits that hold, budgets and permutations."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest

from tierlake.llm.mixing import find_exponent, mix_sources

SCHEMA = "doc_id long, text string, source string, n_tokens long, group string"


def weights(tokens, a):
    power = [t**a for t in tokens]
    return [p / sum(power) for p in power]


def entropy(shares):
    return -sum(s * math.log(s) for s in shares)


@pytest.mark.parametrize(("tokens", "target"), [([1000, 100, 10], 0.8), ([5, 4000, 70, 70], 0.97), ([10, 10], 1.0), ([1000], 0.9), ([9, 8, 7], 0.5)])
def test_entropy_is_met_with_the_largest_exponent(spark, tokens, target):
    sources = spark.createDataFrame([(t,) for t in tokens], "tokens long")
    a = find_exponent(sources, sum(tokens), target, 1e9)
    goal = target * math.log(len(tokens))
    assert 0 <= a <= 1 and entropy(weights(tokens, a)) >= goal - 1e-6
    if a < 1:
        assert entropy(weights(tokens, a + 1e-5)) < goal + 1e-9


def test_repetition_is_limited(spark):
    tokens = [100_000, 1000, 10]
    sources = spark.createDataFrame([(t,) for t in tokens], "tokens long")
    a = find_exponent(sources, sum(tokens), 1.0, 3.0)
    repeats = max(sum(tokens) * w / t for w, t in zip(weights(tokens, a), tokens, strict=True))
    assert repeats == pytest.approx(3.0, abs=1e-4)
    assert find_exponent(sources, 10 * sum(tokens), 1.0, 3.0) == 1.0


@pytest.fixture(scope="module")
def sources(spark):
    rows = [(i, "w " * (1 + i % 7), "big", 0, "x") for i in range(900)] + [(1000 + i, "w " * 5, "small", 0, "x") for i in range(40)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def test_quotas_are_used_and_passes_are_whole(sources):
    used = mix_sources(sources, entropy_share=0.8, max_repeats=100.0, block_tokens=64).collect()
    tokens = {"big": sum(1 + i % 7 for i in range(900)), "small": 200}
    budget, spent = sum(tokens.values()), Counter()
    passes = defaultdict(Counter)
    for row in used:
        spent[row["source"]] += row["n_tokens"]
        passes[row["source"], row["epoch"]][row["doc_id"]] += 1
    assert abs(budget - sum(spent.values())) <= 8
    for (source, epoch), docs in passes.items():
        assert max(docs.values()) == 1
        if (source, epoch + 1) in passes:
            assert len(docs) == {"big": 900, "small": 40}[source]
    shares = [s / sum(spent.values()) for s in spent.values()]
    assert entropy(shares) == pytest.approx(0.8 * math.log(2), abs=0.02)
    # a block's documents are together in the training order, and the order differs from pass to pass
    ordered = sorted(used, key=lambda r: (r["mix_key"], r["doc_key"]))
    runs = [k for i, k in enumerate([(r["source"], r["epoch"], r["block"]) for r in ordered]) if not i or k != (ordered[i - 1]["source"], ordered[i - 1]["epoch"], ordered[i - 1]["block"])]
    assert len(runs) == len(set(runs))
    first = [r["doc_id"] for r in ordered if r["source"] == "small" and r["epoch"] == 0]
    again = [r["doc_id"] for r in ordered if r["source"] == "small" and r["epoch"] == 1]
    assert sorted(first) == sorted(again) and first != again


@pytest.mark.parametrize("seed", ["0", "1", "2"])
@pytest.mark.parametrize("block_tokens", [50, 1 << 20])
def test_every_source_gets_its_quota(spark, seed, block_tokens):
    """Long documents, copies of one row, rows without a key: no source misses its quota by more than half a document."""
    rows = [(i, "w " * (1 if i % 9 else 400), "mixed", 0, "x") for i in range(300)]
    rows += [(5000 + i, "v " * 5000, "long", 0, "x") for i in range(2)]
    rows += [(7, "u u u", "copies", 0, "x")] * 700 + [(8, "u u u u", "copies", 0, "x")] * 5
    rows += [(None, "t " * (1 + i % 5), None, 0, "x") for i in range(200)] + [(None, None, None, 0, "x")] * 400
    rows += [(9000 + i, "s", "small", 0, "x") for i in range(100)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    tokens, longest = Counter(), Counter()
    for _, text, source, *_ in rows:
        words = len((text or "").split())
        tokens[source] += words
        longest[source] = max(longest[source], words)
    for budget in (4000, 17_001):
        used = mix_sources(docs, budget=budget, entropy_share=0.9, max_repeats=50.0, block_tokens=block_tokens, block_rows=64, seed=seed).collect()
        a = find_exponent(spark.createDataFrame([(t,) for t in tokens.values()], "tokens long"), budget, 0.9, 50.0)
        spent = Counter()
        for row in used:
            spent[row["source"]] += row["n_tokens"]
        for source, weight in zip(tokens, weights(list(tokens.values()), a), strict=True):
            missed = abs(spent[source] - budget * weight)
            assert spent[source] > 0
            assert missed <= longest[source] / 2 + 1 or spent[source] == longest[source], (source, spent[source], budget * weight)


def test_long_documents_do_not_end_a_pass(spark):
    rows = [(1, "a " * 5000, "x", 0, "x"), (2, "a " * 5000, "x", 0, "x"), (3, "b " * 3000, "y", 0, "x")]
    used = mix_sources(spark.createDataFrame(rows, SCHEMA), budget=4000, entropy_share=0.0).collect()
    assert {r["source"] for r in used} == {"x", "y"} and sum(r["source"] == "x" for r in used) == 1


def test_odd_documents(odd_docs, no_docs):
    used = mix_sources(odd_docs, entropy_share=0.0).collect()
    # the natural mix is one whole pass; sources without tokens are left out
    assert Counter(str(r["doc_id"]) for r in used) == Counter(map(str, [1, 2, 3, 4, 6, 7, 8, 9, 9, 10, None, None, 11, 12])) - Counter()
    assert mix_sources(no_docs).collect() == []
    assert mix_sources(odd_docs.filter("doc_id = 5")).collect() == []
