"""Which batch has been through which step: an append-only table beside the run events.

A step notes its outcome after its data is written. What a run has to do follows from the notes: batches that landed and
have no later outcome, whoever landed them and however an earlier run ended.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierlake.config import PipelineConfig
from tierlake.sources.storage import has_parquet

SCHEMA = "batch_id string, step string, status string, rows bigint, last_value string, noted_at string"


def ledger_path(config: PipelineConfig) -> str:
    return config.layout.monitoring + "/ledger"


def note(
    spark: SparkSession, config: PipelineConfig, batch_id: str, step: str, rows: int, status: str, last_value: str | None = None
) -> None:
    """Add one outcome."""
    row = {"b": batch_id, "s": step, "t": status, "r": rows, "l": last_value, "n": datetime.now(timezone.utc).isoformat()}
    marks = ("CAST(:b AS string) batch_id", "CAST(:s AS string) step", "CAST(:t AS string) status", "CAST(:r AS bigint) rows",
             "CAST(:l AS string) last_value", "CAST(:n AS string) noted_at")
    spark.sql("SELECT " + ", ".join(marks), args=row).write.mode("append").parquet(ledger_path(config))


def notes(spark: SparkSession, config: PipelineConfig) -> DataFrame:
    """All outcomes, none if there is no ledger yet."""
    if not has_parquet(spark, ledger_path(config)):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(ledger_path(config))


def waiting(spark: SparkSession, config: PipelineConfig, done: str, before: str) -> list[str]:
    """Batches with rows from step ``before`` that have no outcome of step ``done``, oldest first."""
    known = notes(spark, config)
    ready = known.filter((F.col("step") == before) & (F.col("rows") > 0)).select("batch_id").distinct()
    settled = known.filter(F.col("step") == done).select("batch_id").distinct()
    return sorted(row[0] for row in ready.join(settled, "batch_id", "left_anti").collect())


def newest(spark: SparkSession, config: PipelineConfig, step: str) -> str | None:
    """The greatest batch id that a step has written: ingestion also lands empty batches."""
    known = notes(spark, config).filter(F.col("step") == step)
    known = known if step == "ingest" else known.filter("rows > 0")
    return known.agg(F.max("batch_id")).first()[0]


def last_value(spark: SparkSession, config: PipelineConfig) -> str | None:
    """The value up to which the source's incremental column has been landed."""
    known = notes(spark, config).filter("step = 'ingest' and last_value is not null")
    return known.agg(F.max_by("last_value", "noted_at")).first()[0]


def landed_up_to(spark: SparkSession, config: PipelineConfig, value: str) -> list[str]:
    """Batches whose greatest value of the incremental column is this one: no other batch has rows with it."""
    known = notes(spark, config).filter((F.col("step") == "ingest") & (F.col("last_value") == value) & (F.col("rows") > 0))
    return sorted(row[0] for row in known.select("batch_id").distinct().collect())
