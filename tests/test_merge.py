"""Merged type 2 dimensions against builds of all rows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tierlake.operators.dimensions import Dimension, build_dimension
from tierlake.operators.transform import OutputColumn
from tierlake.plans.merge import merge_dimension, newest_folders, read_dimension
from tierlake.sources.versions import version_path

SCHEMA = "k string, v string, extra int, at timestamp_ntz"
START = datetime(2024, 1, 1)


def dimension(**changes):
    columns = tuple(OutputColumn(name) for name in ("k", "v", "at"))
    return Dimension(**{**dict(name="d", business_key=("k",), surrogate_key="sk", columns=columns, scd_type=2, valid_from="at", tracked=("v",)), **changes})


def row(key, value, hour):
    return key, value, 0, None if hour is None else START + timedelta(hours=hour)


def rows_of(frame):
    return sorted((tuple(r[name] for name in ("k", "v", "valid_from", "valid_to", "is_current", "hash_data", "sk")) for r in frame.collect()), key=str)


def merged(spark, path, batches, **options):
    for batch in batches:
        merge_dimension(spark.createDataFrame(batch, SCHEMA), dimension(), path, **options)
    return read_dimension(spark, path)


BATCHES = {
    "in order": [[row("a", "x", 1), row("b", "x", 1)], [row("a", "y", 5)], [row("a", "z", 9), row("c", "x", 2)]],
    "late row splits a version": [[row("a", "x", 1), row("a", "z", 9)], [row("a", "y", 5)]],
    "late row moves a start": [[row("a", "x", 5), row("a", "y", 9)], [row("a", "x", 1), row("a", "y", 3)]],
    "an earlier sight reorders": [[row("a", "x", 5), row("a", "y", 9)], [row("a", "y", 1)]],
    "repeated batch": [[row("a", "x", 1), row("a", "y", 5)], [row("a", "x", 1), row("a", "y", 5)]],
    "no time, no key, equal times": [[row("a", "x", None), row(None, "x", 1)], [row("a", "y", 1), row("a", "z", 1), row("a", None, 1)]],
}


@pytest.mark.parametrize("name", BATCHES)
def test_merges_equal_a_full_build(spark, root, name):
    everything = spark.createDataFrame([r for batch in BATCHES[name] for r in batch], SCHEMA)
    found = merged(spark, root + "dim", BATCHES[name], buckets=3)
    assert rows_of(found) == rows_of(build_dimension(everything, dimension()))


def test_random_batches_in_any_order(spark, root):
    picks = random.Random(4)
    rows = [row(picks.choice("aaabcdef"), picks.choice("uvwxyz"), picks.randrange(60)) for _ in range(120)]
    cuts = [rows[at : at + 40] for at in (80, 0, 40)]
    found = merged(spark, root + "dim", cuts, buckets=4, slots=3)
    assert rows_of(found) == rows_of(build_dimension(spark.createDataFrame(rows, SCHEMA), dimension()))


def test_only_touched_buckets_are_read_and_written(spark, root):
    path = root + "dim"
    first = merge_dimension(spark.createDataFrame([row("k{}".format(n), "x", 1) for n in range(200)], SCHEMA), dimension(), path, 16)
    before = newest_folders(spark, path)
    assert len(first) == len(before) == 16
    touched = merge_dimension(spark.createDataFrame([row("k7", "y", 2)], SCHEMA), dimension(), path, 99)
    after = newest_folders(spark, path)
    assert len(touched) == 1 and [b for b in before if before[b] != after[b]] == touched
    files = read_dimension(spark, path, touched).inputFiles()
    assert files and all("__bucket={}/".format(touched[0]) in name for name in files)
    assert read_dimension(spark, path).count() == 201


def test_a_merge_that_dies_changes_nothing(spark, root):
    path = root + "dim"
    held = rows_of(merged(spark, path, [[row("a", "x", 1)]]))
    spark.createDataFrame([("junk",)], "k string").write.parquet(version_path(path, "left") + "/__bucket=0")
    failing = spark.createDataFrame([row("a", "y", 2)], SCHEMA).withColumn("v", F.expr("raise_error('lost')").cast("string"))
    with pytest.raises(Exception, match="lost"):
        merge_dimension(failing, dimension(), path)
    assert rows_of(read_dimension(spark, path)) == held


def test_empty_batches_and_refused_dimensions(spark, root):
    nothing = spark.createDataFrame([], SCHEMA)
    assert merge_dimension(nothing, dimension(), root + "dim") == [] and read_dimension(spark, root + "dim") is None
    for changes in ({"detect": "changes"}, {"scd_type": 1}):
        with pytest.raises(ValueError, match="can be merged"):
            merge_dimension(nothing, dimension(**changes), root + "dim")
