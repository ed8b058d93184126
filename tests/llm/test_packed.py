"""Packed word hashes, fingerprint coding and the filter of bounded size against plain Python."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierlake.llm.common import mark_probable, shingles, text_slices
from tierlake.llm.exact_dedup import golomb_decode, golomb_encode

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="abAB é\n\t\x0b\x1cß", max_size=40)), max_size=12)


def plain_shingles(text, size):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if len(words) < size:
        return [tuple(words)] if words else []
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]


@settings(max_examples=150, deadline=None)
@given(texts, st.integers(1, 5), st.integers(1, 30))
def test_shingles_are_the_word_sequences(values, size, limit):
    found, names = [[] for _ in values], {}
    for first, offsets, content in text_slices(pa.array(values, pa.string()), limit):
        for row, value in zip(*shingles(offsets, content, size), strict=True):
            found[first + row].append(int(value))
    for text, got in zip(values, found, strict=True):
        expected = plain_shingles(text, size)
        assert len(got) == len(expected)
        for name, value in zip(expected, got, strict=True):
            assert names.setdefault(name, value) == value
    assert len(set(names.values())) == len(names)


@settings(max_examples=150, deadline=None)
@given(st.sets(st.integers(0, 2**63 - 1), max_size=60))
def test_golomb_round_trip(values):
    ordered = np.array(sorted(values), dtype=np.uint64)
    assert golomb_decode(golomb_encode(ordered)).tolist() == ordered.tolist()


def test_golomb_is_smaller_than_plain():
    values = np.unique(np.random.default_rng(1).integers(0, 2**48, 20_000, dtype=np.uint64))
    assert len(golomb_encode(values)) < 0.7 * 8 * values.size


@pytest.mark.parametrize("bits", [64, 4096])
def test_filter_names_all_keys(spark, bits):
    frame = spark.range(300).select(F.col("id").alias("k"))
    marked = mark_probable(frame, F.col("k"), spark.range(0, 300, 7).toDF("x"), bits, "hit").collect()
    assert len(marked) == 300
    assert all(r["hit"] for r in marked if r["k"] % 7 == 0)
    assert bits == 64 or sum(r["hit"] for r in marked) < 80
