"""Type 2 dimensions that are kept up to date: a batch is merged into the stored versions instead of building all of them again.

The stored dimension lies in buckets of its business key. A merge reads the buckets its batch touches and no others, builds
the versions of the batch's keys anew from what is stored of them and the batch's rows, carries the other keys of these
buckets over, and writes the buckets to a folder of its own. The commit table then names, in one file, the newest folder of
each bucket: readers see all of a merge or nothing, and a run that dies leaves the dimension as it was.

A merge gives what a build of all rows so far gives, in whatever order batches come: a version is the first sight of a
content per key, and the first of (the first stored, the batch's rows) is the first of all. A late row therefore moves a
start, closes or splits a version, or reopens the one before, as needed. ``detect: changes`` can't be merged that way (rows
between two changes aren't stored) and is refused.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierlake.functions.scalars import quoted
from tierlake.operators.dimensions import Dimension, build_versions, version_keys, version_rows
from tierlake.sources.staging import stage
from tierlake.sources.versions import commits_path, version_path

#: Buckets of a new dimension; choose them so that a task can hold the versions of one.
BUCKETS = 64
BUCKET = "__bucket"
SCHEMA = "version string, bucket int, buckets int, committed_at string"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[quoted(key) for key in keys]), F.lit(buckets)).cast("int")


def _commits(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(SCHEMA).parquet(commits_path(path))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def newest_folders(spark: SparkSession, path: str) -> dict[int, str]:
    """The folder with the current rows of every bucket that has any: at most a name per bucket."""
    notes = _commits(spark, path)
    if notes is None:
        return {}
    found = notes.groupBy("bucket").agg(F.max_by("version", F.struct("committed_at", "version")).alias("version")).collect()
    return {row["bucket"]: "{}/{}={}".format(version_path(path, row["version"]), BUCKET, row["bucket"]) for row in found}


def read_dimension(spark: SparkSession, path: str, buckets: Sequence[int] | None = None) -> DataFrame | None:
    """The stored versions, or those of some buckets only; None if there are none. Other buckets' files aren't listed."""
    folders = newest_folders(spark, path)
    wanted = [folder for bucket, folder in sorted(folders.items()) if buckets is None or bucket in set(buckets)]
    return spark.read.parquet(*wanted) if wanted else None


def merge_dimension(
    batch: DataFrame, dimension: Dimension, path: str, buckets: int = BUCKETS, slots: int | None = None
) -> list[int]:
    """Merge the rows of ``batch`` into the type 2 dimension stored at ``path``; returns the buckets that were rewritten.

    Rows without a complete business key are left out, as in a full build; an empty batch changes nothing, and a batch that
    was merged before gives the same versions again. The number of buckets is fixed by the first merge.
    """
    spark = batch.sparkSession
    if dimension.scd_type != 2 or dimension.detect != "distinct":
        raise ValueError("{}: only type 2 dimensions with detect: distinct can be merged".format(dimension.name))
    notes = _commits(spark, path)
    known = notes.agg(F.max("buckets")).first()[0] if notes is not None else None
    buckets = known or buckets
    keys = version_keys(dimension)
    rows = version_rows(batch, dimension)
    fresh = stage(rows.withColumn(BUCKET, _bucket(keys, buckets)), "batch")
    touched = sorted(row[0] for row in fresh.select(BUCKET).distinct().collect())
    if not touched:
        return []
    fresh, held = fresh.drop(BUCKET), read_dimension(spark, path, touched)
    if held is None:
        built = build_versions(fresh, dimension, slots)
    else:
        asked = stage(fresh.select(*[quoted(key) for key in keys]).distinct(), "asked")
        own = held.join(asked, keys, "left_semi").select(*[quoted(name) for name in rows.columns])
        again = stage(build_versions(stage(own.unionByName(fresh), "rows"), dimension, slots), "versions")
        rest = held.join(asked, keys, "left_anti").select(*[quoted(name) for name in again.columns])
        built = again.unionByName(rest)
    moment = datetime.now(timezone.utc)
    version = "{}-{}".format(moment.strftime("%Y%m%dT%H%M%S%fZ"), uuid.uuid4().hex[:8])
    placed = built.withColumn(BUCKET, _bucket(keys, buckets))
    placed.repartition(F.col(BUCKET)).write.partitionBy(BUCKET).parquet(version_path(path, version))
    told = [(version, bucket, buckets, moment.isoformat()) for bucket in touched]
    spark.createDataFrame(told, SCHEMA).coalesce(1).write.mode("append").parquet(commits_path(path))
    return touched
