"""Where datasets live and how they are read and written."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# The batch folder name and the time format of a batch id.
BATCH_COLUMN = "ingestion_timestamp"
BATCH_FORMAT = "%Y%m%dT%H%M%SZ"


def batch_path(base: str, batch_id: str, name: str = BATCH_COLUMN) -> str:
    return "{}/{}={}".format(base.rstrip("/"), name, batch_id)


def reject_prefix(tech_prefix: str) -> str:
    """Default folder of rejected rows: the TECH folder with its first level named ``tech`` called ``reject`` instead."""
    found, count = re.subn(r"(?:(?<=/)|^)tech(?=/|$)", "reject", tech_prefix.strip("/"), count=1)
    if not count:
        raise ValueError("No level of silver.tech.prefix is named tech: set silver.reject")
    return found


@dataclass(frozen=True)
class Layout:
    """Absolute dataset paths of one pipeline below a root such as ``s3a://`` or ``file:///data/``."""

    root: str
    pipeline: str
    bronze_location: tuple[str, str]
    raw_location: tuple[str, str]
    tech_location: tuple[str, str]
    func_location: tuple[str, str]
    gold_location: tuple[str, str] | None
    monitoring_location: tuple[str, str]
    reject_location: tuple[str, str] | None = None

    def _join(self, location: tuple[str, str]) -> str:
        root = self.root if self.root.endswith("/") else self.root + "/"
        return "{}{}/{}".format(root, location[0], location[1].strip("/"))

    @property
    def bronze(self) -> str:
        return self._join(self.bronze_location)

    @property
    def raw(self) -> str:
        return self._join(self.raw_location)

    @property
    def tech(self) -> str:
        return self._join(self.tech_location)

    @property
    def reject(self) -> str:
        return self._join(self.reject_location or (self.tech_location[0], reject_prefix(self.tech_location[1])))

    @property
    def func(self) -> str:
        return self._join(self.func_location)

    @property
    def gold(self) -> str:
        if self.gold_location is None:
            raise ValueError("Configuration has no gold section")
        return self._join(self.gold_location)

    @property
    def monitoring(self) -> str:
        return self._join(self.monitoring_location)

    def gold_table(self, path: str) -> str:
        return "{}/{}".format(self.gold, path)


def _files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame | None:
    """Paths of the files below a folder, None if there is no such folder. Contents aren't read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    try:
        return reader.load(path).select("path")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there a file below the path?"""
    found = _files(spark, path)
    return found is not None and not found.isEmpty()


def has_parquet(spark: SparkSession, path: str) -> bool:
    """Is there a Parquet file anywhere below the path?"""
    found = _files(spark, path, "*.parquet")
    return found is not None and not found.isEmpty()


def batch_ids(spark: SparkSession, base: str, name: str = BATCH_COLUMN) -> list[str]:
    """Batch ids below a dataset in text order, from the names of its files' folders; ids made of digits stay text.

    The work list of a pipeline comes from its ledger; this is for data that others wrote.
    """
    found = _files(spark, base)
    if found is None:
        raise ValueError("There is no dataset at {}".format(base))
    folder = F.regexp_extract("path", "/{}=([^/]+)/".format(re.escape(name)), 1)
    return sorted(row[0] for row in found.select(folder).distinct().collect() if row[0])


def latest_batch(spark: SparkSession, base: str, name: str = BATCH_COLUMN) -> str:
    """The greatest batch id in text order."""
    found = batch_ids(spark, base, name)
    if not found:
        raise ValueError("{} holds no batch folder {}=...".format(base, name))
    return found[-1]


def merged_schema(spark: SparkSession, *paths: str) -> T.StructType:
    """The columns of all files together; batch folders can hold files of different columns."""
    fields = spark.read.option("mergeSchema", "true").parquet(*paths).schema.fields
    return T.StructType([field for field in fields if field.name != BATCH_COLUMN])


CORRUPT = "_corrupt_record"


def text_schema(columns: Iterable[str]) -> str:
    """The columns as text, and one for lines that are no JSON."""
    return ", ".join("`{}` string".format(name) for name in [*(c for c in columns if c != CORRUPT), CORRUPT])


def read_jsonl(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """JSON lines with every scalar as text and nested values kept; lines that are no JSON are in ``_corrupt_record``.

    With ``columns`` the schema is taken as given (all text) and the extra pass over the files that inference needs
    is saved; nested values then arrive as their JSON text, and fields that aren't listed stay in Bronze only.
    """
    reader = spark.read.option("primitivesAsString", "true").option("columnNameOfCorruptRecord", CORRUPT)
    if columns is not None:
        reader = reader.schema(text_schema(columns))
    return reader.json(path)


def add_load_columns(frame: DataFrame) -> DataFrame:
    """Source file and load time of every row. Apply it right after the read."""
    return frame.withColumns(
        {"_source_file": F.col("_metadata.file_path"), "_raw_loaded_at": F.current_timestamp()}
    )


def read_bronze(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    return add_load_columns(read_jsonl(spark, path, columns))


def between(frame: DataFrame, column: str, start: Any, end: Any) -> DataFrame:
    """Rows inside an inclusive range. On a Parquet scan the filter reaches the files."""
    return frame.filter(F.col(column).between(F.lit(start), F.lit(end)))


def limit_files(frame: DataFrame, partitions: int | None) -> DataFrame:
    """Cap the number of output files.

    A shuffle spreads the rows evenly and, unlike ``coalesce``, leaves the parallelism of the work before it alone.
    """
    return frame if partitions is None else frame.repartition(int(partitions))


_MOMENT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
#: How rows become JSON lines.
LINE_OPTIONS = {"ignoreNullFields": "false", "timestampNTZFormat": _MOMENT, "timestampFormat": _MOMENT + "XXX"}


def write_jsonl(frame: DataFrame, path: str, lines: bool = False) -> None:
    """Land rows as JSON lines, replacing the folder. NULLs and microseconds are kept.

    With ``lines`` the frame's only column holds JSON lines already.
    """
    if lines:
        frame.write.mode("overwrite").text(path)
        return
    frame.write.mode("overwrite").options(**LINE_OPTIONS).json(path)


def write_parquet(frame: DataFrame, path: str, mode: str) -> None:
    frame.write.mode(mode).parquet(path)
