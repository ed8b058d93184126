"""Datasets that are replaced as a whole: versioned folders and one committed pointer.

A new version is written to a folder of its own, ``v=<name>``, and only then noted in the dataset's commits, a small table
beside the versions. Readers take the newest committed version, so they see the old rows until the new ones are complete, and
a run that dies leaves the old version in place and an unnoted folder that nobody reads. Versions are kept for readers that
still hold them until ``KEEP`` newer ones are there; then their rows are removed.

A dataset without commits is a plain folder of files and is read as such.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tierlake.sources.storage import write_parquet

#: Versions that stay readable after they were replaced.
KEEP = 1
SCHEMA = "version string, committed_at string, emptied boolean"


def commits_path(path: str) -> str:
    """Spark skips names with an underscore when it reads the folder above."""
    return "{}/_commits".format(path.rstrip("/"))


def version_path(path: str, version: str) -> str:
    return "{}/v={}".format(path.rstrip("/"), version)


def committed(spark: SparkSession, path: str) -> list[str]:
    """Versions with rows, newest first: a handful of names."""
    try:
        notes = spark.read.schema(SCHEMA).parquet(commits_path(path))
        rows = notes.groupBy("version").agg(F.min("committed_at").alias("at"), F.max("emptied").alias("emptied"))
        return [row["version"] for row in rows.filter("not emptied").orderBy(F.desc("at"), F.desc("version")).collect()]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def current_path(spark: SparkSession, path: str) -> str:
    """Where the dataset's rows are now."""
    versions = committed(spark, path)
    return version_path(path, versions[0]) if versions else path


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The dataset's rows as of its newest version."""
    return spark.read.parquet(current_path(spark, path))


def _note(spark: SparkSession, path: str, version: str, emptied: bool) -> None:
    row = {"v": version, "at": datetime.now(timezone.utc).isoformat(), "e": emptied}
    told = "SELECT CAST(:v AS string) version, CAST(:at AS string) committed_at, CAST(:e AS boolean) emptied"
    spark.sql(told, args=row).coalesce(1).write.mode("append").parquet(commits_path(path))


def _empty(spark: SparkSession, path: str, version: str) -> None:
    """Replace a version's files by one without rows."""
    folder = version_path(path, version)
    nothing = spark.createDataFrame([], spark.read.parquet(folder).schema)
    nothing.coalesce(1).write.mode("overwrite").parquet(folder)


def replace_dataset(frame: DataFrame, path: str, keep: int = KEEP) -> str:
    """Write the frame as the dataset's new version, commit it, and remove the rows of versions ``keep`` back; its path.

    The frame may read the dataset itself. An error while writing leaves the dataset as it was.
    """
    spark = frame.sparkSession
    before = committed(spark, path)
    name = "{}-{}".format(datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%fZ"), uuid.uuid4().hex[:8])
    folder = version_path(path, name)
    write_parquet(frame, folder, "errorifexists")
    _note(spark, path, name, False)
    for version in before[keep:]:
        _empty(spark, path, version)
        _note(spark, path, version, True)
    return folder
