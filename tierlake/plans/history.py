"""Histories that grow by new versions only: stored by buckets of key and content, with a bit table per bucket beside them.

A batch is de-duplicated, its rows fall into buckets by a hash of their key and content hash, and the bit tables of these buckets
tell which rows are surely new. Only buckets in which some row may be known are read, only their key columns, and compared
exactly; bits never decide on their own. Bits are kept as the 64-bit words that are set, so a young history's tables are small
and an old one's are bounded (``bits`` / 8 bytes a bucket and run, at most); a full table costs reads and changes nothing.

A run writes rows and bits to folders of its own and then commits them by one note in ``_history``. Readers take committed runs
only, so a run that dies appends nothing, and running it again appends its rows once.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierlake.functions.scalars import quoted
from tierlake.operators.dedup import Dedup, deduplicate
from tierlake.sources.staging import stage
from tierlake.sources.storage import path_exists
from tierlake.sources.versions import version_path

#: Buckets of a new history, and bits of each bucket's table. Choose buckets so that a task can hold the keys of one.
BUCKETS = 64
BITS = 1 << 30
BUCKET = "__bucket"
RUN = "__run"
_MARK, _SLOT, _WORD = "__mark", "__slot", "__word"
SCHEMA = "run string, buckets int, bits long, rows long, committed_at string"


def notes_path(path: str) -> str:
    return "{}/_history".format(path.rstrip("/"))


def rows_path(path: str) -> str:
    return version_path(path, "history")


def _bits_path(path: str) -> str:
    return "{}/_history_bits".format(path.rstrip("/"))


def _notes(spark: SparkSession, path: str) -> DataFrame | None:
    """The committed runs, None if there is no history."""
    try:
        return spark.read.schema(SCHEMA).parquet(notes_path(path))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def is_history(spark: SparkSession, path: str) -> bool:
    return _notes(spark, path) is not None


def _folders(base: str, buckets: list[int]) -> list[str]:
    return ["{}/{}={}".format(base, BUCKET, bucket) for bucket in buckets]


def _committed(spark: SparkSession, base: str, buckets: list[int] | None, runs: DataFrame) -> DataFrame | None:
    """What committed runs wrote below ``base``, of all buckets or of some; other buckets' files aren't listed."""
    wanted = [base] if buckets is None else [folder for folder in _folders(base, buckets) if path_exists(spark, folder)]
    if not wanted or not path_exists(spark, wanted[0]):
        return None
    reader = spark.read.option("basePath", base).option("mergeSchema", str(buckets is None).lower())
    return reader.parquet(*wanted).join(runs.select(F.col("run").alias(RUN)).distinct(), RUN, "left_semi")


def read_history(spark: SparkSession, path: str, buckets: list[int] | None = None) -> DataFrame | None:
    """The history's rows, or those of some buckets; None if there are none."""
    runs = _notes(spark, path)
    rows = None if runs is None else _committed(spark, rows_path(path), buckets, runs)
    return None if rows is None else rows.drop(BUCKET, RUN)


def _hash(keys: list[str], salt: int) -> Column:
    # NULL and its neighbours hash apart: each column is followed by whether it is NULL
    parts = [part for key in keys for part in (quoted(key).cast("string"), quoted(key).isNull())]
    return F.xxhash64(F.lit(salt), *parts)


def _placed(rows: DataFrame, keys: list[str], buckets: int, bits: int) -> DataFrame:
    return rows.withColumns(
        {BUCKET: F.pmod(_hash(keys, 1), F.lit(buckets)).cast("int"), _MARK: F.pmod(_hash(keys, 2), F.lit(bits))}
    )


def _slot() -> Column:
    return (F.col(_MARK) / 64).cast("long").alias(_SLOT)


def _append(rows: DataFrame, path: str, buckets: int, bits: int) -> int:
    """Write placed rows and their bits, then commit both; the number of rows."""
    spark, moment = rows.sparkSession, datetime.now(timezone.utc)
    run = "{}-{}".format(moment.strftime("%Y%m%dT%H%M%S%fZ"), uuid.uuid4().hex[:8])
    kept = stage(rows, "appended")
    count = kept.count()
    if count:
        spread = kept.drop(_MARK).withColumn(RUN, F.lit(run)).hint("rebalance", F.col(BUCKET))
        spread.write.mode("append").partitionBy(BUCKET, RUN).parquet(rows_path(path))
        word = F.bit_or(F.expr("shiftleft(1L, cast(`{}` % 64 as int))".format(_MARK))).alias(_WORD)
        words = kept.groupBy(BUCKET, _slot()).agg(word).withColumn(RUN, F.lit(run))
        words.write.mode("append").partitionBy(BUCKET, RUN).parquet(_bits_path(path))
    note = spark.createDataFrame([(run, buckets, bits, count, moment.isoformat())], SCHEMA)
    note.coalesce(1).write.mode("append").parquet(notes_path(path))
    return count


def probable_buckets(fresh: DataFrame, path: str) -> list[int]:
    """Buckets in which some row of ``fresh`` (placed) may be known already: one number per bucket."""
    spark = fresh.sparkSession
    touched = sorted(row[0] for row in fresh.select(BUCKET).distinct().collect())
    words = _committed(spark, _bits_path(path), touched, _notes(spark, path)) if touched else None
    if words is None:
        return []
    asked = fresh.select(BUCKET, _MARK, _slot()).distinct()
    found = asked.join(words, [BUCKET, _SLOT]).filter("getbit(`{}`, cast(`{}` % 64 as int)) = 1".format(_WORD, _MARK))
    return sorted(row[0] for row in found.select(BUCKET).distinct().collect())


def append_history(batch: DataFrame, dedup: Dedup, path: str, buckets: int = BUCKETS, bits: int = BITS) -> int:
    """Append the versions of ``batch`` that the history at ``path`` doesn't hold; the number of rows.

    Buckets and bits are fixed by the first run. Rows that lie at ``path`` as a plain dataset become the history's first run, as
    they are. An empty batch appends nothing. NULL keys are keys like others.
    """
    if dedup.strategy != "history":
        raise ValueError("Only histories are appended to by their versions")
    if bits % 64 or bits < 64 or buckets < 1:
        raise ValueError("A history needs a bucket and a multiple of 64 bits")
    spark, keys = batch.sparkSession, [*dedup.keys, dedup.hash_column]
    runs = _notes(spark, path)
    if runs is not None:
        buckets, bits = runs.agg(F.max("buckets"), F.max("bits")).first()
    elif path_exists(spark, path):
        _append(_placed(spark.read.parquet(path), keys, buckets, bits), path, buckets, bits)
    fresh = stage(_placed(deduplicate(batch, dedup), keys, buckets, bits), "fresh")
    hit = probable_buckets(fresh, path) if is_history(spark, path) else []
    known = _committed(spark, rows_path(path), hit, _notes(spark, path)) if hit else None
    if known is not None:
        same = [F.col("new.`{0}`".format(key)).eqNullSafe(F.col("known.`{0}`".format(key))) for key in (BUCKET, *keys)]
        fresh = fresh.alias("new").join(known.select(BUCKET, *[quoted(key) for key in keys]).alias("known"), same, "left_anti")
    return _append(fresh, path, buckets, bits)
