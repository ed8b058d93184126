"""The configured source as a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType

from tierlake.config import SourceConfig
from tierlake.functions.scalars import quoted
from tierlake.sources import paged
from tierlake.sources.storage import CORRUPT, LINE_OPTIONS, between

LINE_SCHEMA = "value string"


def is_lines(source: SourceConfig) -> bool:
    """Does the source deliver JSON lines in one column?"""
    return source.type == "api" and "schema" not in source.options


def read_pages(spark: SparkSession, source: SourceConfig) -> DataFrame:
    """All pages of a paged source; ``provider`` names the transport, which also gets the configured range.

    Without a ``schema`` the rows come as JSON lines in one column, to be landed as they are.
    """
    paged.register(spark)
    schema = source.options.get("schema", LINE_SCHEMA)
    options = {key: str(value) for key, value in source.options.items() if key != "schema"}
    if source.filter:
        options.update({"filter_{}".format(key): str(source.filter[key]) for key in ("column", "start", "end")})
    return (
        spark.read.format("paged")
        .schema(schema)
        .options(
            **options,
            transport=source.provider,
            page_size=source.page_size,
            max_rows=source.max_rows,
            max_retries=source.max_retries,
            request_timeout_seconds=source.request_timeout_seconds,
        )
        .load()
    )


def read_files(spark: SparkSession, source: SourceConfig) -> DataFrame:
    """A drop folder of CSV, JSON-lines or Parquet files; ``schema_mode: declared`` takes ``schema`` as given.

    JSON lines are read as they are. The folder is a ``location``, or ``bucket`` and ``prefix`` below ``root``.
    """
    options = source.options
    kind = options.get("format", "parquet")
    if kind not in ("csv", "jsonl", "json", "parquet"):
        raise ValueError("Unsupported file format: {}".format(kind))
    reader = spark.read.format("json" if kind == "jsonl" else kind)
    if kind == "csv":
        reader = reader.option("header", "true")
    if kind in ("json", "jsonl"):
        reader = reader.option("primitivesAsString", "true").option("columnNameOfCorruptRecord", CORRUPT)
    if options.get("schema_mode", "infer") == "declared":
        keeps = kind in ("csv", "parquet") or CORRUPT in options["schema"]
        reader = reader.schema(options["schema"] if keeps else "{}, {} string".format(options["schema"], CORRUPT))
    return reader.load(file_location(source))


def file_location(source: SourceConfig) -> str:
    """Folder of a file source."""
    options = source.options
    if "location" in options:
        return options["location"]
    return "{}{}/{}".format(options.get("root", ""), options["bucket"], str(options["prefix"]).strip("/"))


def row_text(frame: DataFrame) -> Column:
    """A row as the JSON line that Bronze holds of it."""
    return F.to_json(F.struct(*[quoted(name) for name in frame.columns]), LINE_OPTIONS)


def _unseen(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows without those whose lines ``seen`` (``value``) holds, copy by copy: of equal rows only the additional ones."""
    held = seen.groupBy(F.sha2("value", 256).alias("digest")).agg(F.count(F.lit(1)).alias("held"))
    whole = F.struct(*[quoted(name) for name in rows.columns])
    found = rows.groupBy(F.sha2(row_text(rows), 256).alias("digest")).agg(F.first(whole).alias("row"), F.count(F.lit(1)).alias("found"))
    more = found.join(held, "digest", "left").withColumn("more", F.col("found") - F.coalesce("held", F.lit(0))).filter("more > 0")
    return more.select("row", F.explode(F.expr("sequence(1L, more)"))).select("row.*")


def read_table(spark: SparkSession, source: SourceConfig, after: object = None, seen: Callable[[DataType], DataFrame] | None = None) -> DataFrame:
    """A catalog table or a JDBC table; with ``incremental_column`` only rows after the last value seen.

    ``seen`` gives the lines (``value``) already landed of rows at the last value, for the column's type: rows that came late
    with just that value are read then as well, those landed before are not. NULLs in the column are read by the first run only.
    """
    options = source.options
    if "connection" in options:
        name = ".".join(part for part in (options.get("schema"), options["table"]) if part)
        frame = spark.read.format("jdbc").options(**options["connection"], dbtable=name).load()
    else:
        frame = spark.read.table(options["table"])
    last = options.get("after") if after is None else after
    if options.get("incremental_column") and last is not None:
        column = options["incremental_column"]
        kind = frame.schema[column].dataType
        mark, values = F.lit(last).cast(kind), quoted(column)
        later = frame.filter(values > mark)
        return later if seen is None else later.unionByName(_unseen(frame.filter(values == mark), seen(kind)))
    return frame


def read_source(
    spark: SparkSession, source: SourceConfig, after: object = None, seen: Callable[[DataType], DataFrame] | None = None
) -> DataFrame:
    """Rows of the source inside its configured range; of a table only those after ``after`` or not ``seen`` at it, if given.

    A paged source's range goes to its transport, which applies it before rows are counted. Rows that land as JSON text are
    not filtered again.
    """
    if source.type == "api":
        frame = read_pages(spark, source)
    elif source.type == "file":
        frame = read_files(spark, source)
    elif source.type == "table":
        frame = read_table(spark, source, after, seen)
    else:
        raise ValueError("Sources of type {} are read as a stream".format(source.type))
    if source.filter and source.filter["column"] in frame.columns:
        frame = between(frame, source.filter["column"], source.filter["start"], source.filter["end"])
    return frame
