"""Run events: one small Parquet row per state change of a step."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import SparkSession, types as T

from tierlake.config import PipelineConfig

_LONGS = ("row_count", "rejected_count")

# Event columns in stored order.
EVENT_COLUMNS = (
    "pipeline", "event_timestamp", "layer", "dataset_name", "dataset_type", "status", "batch_id", "input_path",
    "output_path", "row_count", "rejected_count", "reject_path", "write_mode", "dedup_strategy", "error_type",
    "error_message",
)
GOLD_COLUMNS = (
    "pipeline", "event_timestamp", "layer", "status", "input_path", "output_path", "row_count", "error_type",
    "error_message", "dataset_type", "dataset_name",
)


def _schema(names: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(name, T.LongType() if name in _LONGS else T.StringType()) for name in names])


EVENT_SCHEMA = _schema(EVENT_COLUMNS)
GOLD_SCHEMA = _schema(GOLD_COLUMNS)


def event_path(config: PipelineConfig, event: Mapping[str, Any]) -> str:
    root = config.layout.monitoring
    if event["layer"] != "gold":
        return "{}/{}".format(root, event["layer"])
    kind = "dimensions" if event["dataset_type"] == "dimension" else "facts"
    return "{}/gold/{}/{}".format(root, kind, event["dataset_name"])


def write_event(spark: SparkSession, config: PipelineConfig, event: Mapping[str, Any]) -> None:
    """Append one event; missing texts are empty and missing counts 0."""
    schema = GOLD_SCHEMA if event["layer"] == "gold" else EVENT_SCHEMA
    values = {
        "status": "success",
        **event,
        "pipeline": config.name,
        "event_timestamp": datetime.now(timezone.utc).isoformat(),
    }
    row = {field.name: values.get(field.name, 0 if field.name in _LONGS else "") for field in schema.fields}
    selected = ", ".join("CAST(:{0} AS {1}) AS {0}".format(item.name, item.dataType.simpleString()) for item in schema)
    spark.sql("SELECT " + selected, args=row).write.mode("append").parquet(event_path(config, values))


@contextmanager
def monitored(
    spark: SparkSession,
    config: PipelineConfig,
    locate: Callable[[], Mapping[str, Any]] = dict,
    **about: Any,
) -> Iterator[dict[str, Any]]:
    """Events around one step: ``started``, then the outcome the step notes down, or ``failed`` with the error.

    ``locate`` finds the step's batch and paths; its errors are failures of the step like any other. The step adds
    what it learns (counts, status) to the yielded mapping.
    """
    facts: dict[str, Any] = dict(about)
    missing: Exception | None = None
    try:
        facts.update(locate())
    except Exception as error:
        missing = error
    write_event(spark, config, {**facts, "status": "started"})
    try:
        if missing is not None:
            raise missing
        yield facts
    except Exception as error:
        outcome = {"status": "failed", "error_type": type(error).__name__, "error_message": str(error)}
        write_event(spark, config, {**facts, **outcome})
        raise
    write_event(spark, config, facts)
