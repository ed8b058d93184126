"""Replacing a dataset: readers see the old rows until the new ones are complete."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tierlake.sources.versions import committed, current_path, read_current, replace_dataset, version_path


def ids(frame):
    return sorted(row[0] for row in frame.select("id").collect())


def test_newest_version_is_read(spark, root):
    path = root + "data"
    assert committed(spark, path) == [] and current_path(spark, path) == path
    first = replace_dataset(spark.range(3), path)
    assert current_path(spark, path) == first and ids(read_current(spark, path)) == [0, 1, 2]
    second = replace_dataset(spark.range(10, 12), path)
    assert second != first and ids(read_current(spark, path)) == [10, 11]


def test_a_write_that_fails_in_the_middle_leaves_the_old_rows(spark, root):
    path = root + "data"
    replace_dataset(spark.range(3), path)
    failing = spark.range(0, 1000, 1, 4).withColumn("id", F.expr("if(id = 900, raise_error('lost'), id)").cast("long"))
    with pytest.raises(Exception, match="lost"):
        replace_dataset(failing, path)
    assert ids(read_current(spark, path)) == [0, 1, 2] and len(committed(spark, path)) == 1
    replace_dataset(spark.range(5, 7), path)
    assert ids(read_current(spark, path)) == [5, 6]


def test_a_written_but_uncommitted_version_is_not_read(spark, root):
    path = root + "data"
    replace_dataset(spark.range(3), path)
    spark.range(100).write.parquet(version_path(path, "99999999T000000Z-left"))
    assert ids(read_current(spark, path)) == [0, 1, 2]


def test_open_readers_keep_their_version_until_the_grace_is_over(spark, root):
    path = root + "data"
    replace_dataset(spark.range(3), path)
    held, name = read_current(spark, path), committed(spark, path)[0]
    replace_dataset(spark.range(4), path)
    assert ids(held) == [0, 1, 2] and len(committed(spark, path)) == 2
    replace_dataset(spark.range(5), path)
    assert name not in committed(spark, path) and len(committed(spark, path)) == 2
    assert spark.read.parquet(version_path(path, name)).count() == 0


def test_a_version_may_be_made_from_the_one_before(spark, root):
    path = root + "data"
    spark.range(3).write.parquet(path)
    for _ in range(3):
        replace_dataset(read_current(spark, path).select((F.col("id") + 1).alias("id")), path)
    assert ids(read_current(spark, path)) == [3, 4, 5]


def test_a_version_without_rows_is_a_version(spark, root):
    path = root + "data"
    replace_dataset(spark.range(3), path)
    replace_dataset(spark.range(0), path)
    assert read_current(spark, path).count() == 0 and read_current(spark, path).columns == ["id"]
