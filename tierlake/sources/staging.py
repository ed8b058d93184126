"""Intermediate tables in the folder the cluster shares.

A staged table cuts the lineage (a lost executor costs a re-read, not a re-computation) and, being Parquet, tells the
planner its true size: small ones are broadcast by the planner's own size rule, others are shuffled.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}
_scopes: list[list[str]] = []


def staging_root(spark: SparkSession) -> str:
    """Shared folder named by the session; a local session without one gets a temporary folder."""
    root = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set {} to a folder that all executors can reach".format(SETTING))
    application = spark.sparkContext.applicationId
    if application not in _local_roots:
        _local_roots[application] = tempfile.mkdtemp(prefix="tierlake-")
    return "file://" + _local_roots[application]


def _application_folder(spark: SparkSession) -> str:
    return "{}/{}".format(staging_root(spark), spark.sparkContext.applicationId)


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the staging root; nothing is created yet."""
    return "{}/{}-{}".format(_application_folder(spark), label, uuid.uuid4().hex[:12])


def stage(frame: DataFrame, label: str) -> DataFrame:
    """Write the frame to a fresh staged table and read it back with the same schema."""
    spark = frame.sparkSession
    path = new_folder(spark, label)
    for scope in _scopes:
        scope.append(path)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staged_for_now(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside when leaving. Results that read it must be written by then."""
    scope: list[str] = []
    _scopes.append(scope)
    try:
        yield
    finally:
        _scopes[:] = [other for other in _scopes if other is not scope]
        for path in scope:
            _delete(spark, path)


def drop_staged(spark: SparkSession) -> None:
    """Delete everything this application staged. Call it when its results are written."""
    _delete(spark, _application_folder(spark))
