"""The layer transitions: I/O and run events around the pure operators.

Each step reads stored data, writes stored data and counts rows with an observation on the write itself, so nothing
is computed once to be counted and once more to be written.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timezone
from functools import cache
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DataType, StructField, StructType

from tierlake.config import PipelineConfig
from tierlake.operators.dedup import deduplicate
from tierlake.operators.dimensions import build_dimension
from tierlake.operators.facts import build_fact
from tierlake.operators.quality import evaluate
from tierlake.operators.transform import apply_commands, project
from tierlake.plans.history import append_history, is_history, read_history, rows_path
from tierlake.plans.ledger import landed_up_to, last_value, newest, note
from tierlake.plans.monitoring import monitored
from tierlake.sources.readers import is_lines, read_source
from tierlake.sources.staging import stage, staged_for_now
from tierlake.sources.storage import (
    BATCH_COLUMN,
    BATCH_FORMAT,
    LINE_OPTIONS,
    batch_path,
    latest_batch,
    limit_files,
    merged_schema,
    path_exists,
    read_bronze,
    write_jsonl,
    write_parquet,
)
from tierlake.sources.versions import current_path, read_current, replace_dataset
from tierlake.streaming.landing import land_events


@dataclass(frozen=True)
class StepResult:
    status: str
    path: str
    rows: int
    batch_id: str = ""
    reject_path: str = ""
    rejected: int = 0
    batches: tuple[str, ...] = ()


def _counted(frame: DataFrame) -> tuple[DataFrame, Observation]:
    observation = Observation("rows-{}".format(uuid.uuid4().hex))
    return frame.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def _replace_counted(frame: DataFrame, path: str) -> tuple[int, str]:
    """Rows and folder of the dataset's new version."""
    counted, observation = _counted(frame)
    folder = replace_dataset(counted, path)
    return observation.get["rows"], folder


def _write_counted(frame: DataFrame, path: str, mode: str) -> int:
    counted, observation = _counted(frame)
    write_parquet(counted, path, mode)
    return observation.get["rows"]


def new_batch_id() -> str:
    return datetime.now(timezone.utc).strftime(BATCH_FORMAT)


def _batch_mode(config: PipelineConfig, again: bool) -> str:
    return "overwrite" if again or config.batch_write == "replace" else "append"


def _newest(spark: SparkSession, config: PipelineConfig, step: str, base: str) -> str:
    """Newest batch of a step by the ledger, or by its folders if the ledger knows none."""
    return newest(spark, config, step) or latest_batch(spark, base)


def _stale(spark: SparkSession, path: str, mode: str) -> bool:
    """Does a replacing run have older rows to remove, even if it has none to write?"""
    return mode == "overwrite" and path_exists(spark, path)


def _land(spark: SparkSession, config: PipelineConfig, batch_id: str, path: str) -> int:
    """Write one batch of a source that isn't a stream, note it and return its rows."""
    column = config.source.options.get("incremental_column") if config.source.type == "table" else None
    after = last_value(spark, config) if column else None
    batches = landed_up_to(spark, config, after) if after is not None else []

    def seen(kind: DataType) -> DataFrame:
        """Lines that earlier batches hold of rows at the last value."""
        lines = spark.read.text([batch_path(config.layout.bronze, name) for name in batches])
        parsed = F.from_json("value", StructType([StructField(column, kind)]), LINE_OPTIONS)[column]
        return lines.filter(parsed == F.lit(after).cast(kind)).select("value")

    frame = read_source(spark, config.source, after, seen if batches else None)
    observation = Observation("rows-{}".format(uuid.uuid4().hex))
    measures = [F.count(F.lit(1)).alias("rows")]
    if column:
        measures.append(F.max(F.col(column)).cast("string").alias("last"))
    write_jsonl(frame.observe(observation, *measures), path, lines=is_lines(config.source))
    rows = observation.get["rows"]
    note(spark, config, batch_id, "ingest", rows, "success" if rows else "no_data", observation.get.get("last"))
    return rows


def ingest(spark: SparkSession, config: PipelineConfig, batch_id: str | None = None) -> StepResult:
    """Source to Bronze: the rows as JSON lines in a new batch folder.

    An event source lands one batch per micro-batch and names them itself. A table with an incremental column goes on after
    the greatest value landed so far. A paged source that reaches its ``max_rows`` ends as ``truncated``.
    """
    streamed = config.source.type == "events"
    batch_id = "" if streamed else batch_id or new_batch_id()
    path = config.layout.bronze if streamed else batch_path(config.layout.bronze, batch_id)
    origin = str(config.source.options.get("endpoint") or config.source.options.get("location") or "")
    with monitored(spark, config, layer="bronze", batch_id=batch_id, input_path=origin, output_path=path) as facts:
        if streamed:
            landed = land_events(spark, config)
        else:
            landed = [(batch_id, _land(spark, config, batch_id, path))]
        rows = sum(count for _, count in landed)
        batches = tuple(name for name, count in landed if count)
        full = config.source.type == "api" and rows >= (config.source.max_rows or 0) > 0
        status = "truncated" if full else "success" if rows else "no_data"
        facts.update(batch_id=batches[-1] if batches else batch_id, row_count=rows, status=status)
    return StepResult(facts["status"], path, rows, facts["batch_id"], batches=batches)


def bronze_to_raw(
    spark: SparkSession, config: PipelineConfig, batch_id: str | None = None, again: bool = False
) -> StepResult:
    """Newest (or given) Bronze batch to RAW: text columns plus source file and load time.

    With ``again`` the batch's folder is replaced, as after a run that didn't end.
    """
    layout = config.layout

    def locate() -> dict[str, Any]:
        found = batch_id or _newest(spark, config, "ingest", layout.bronze)
        return {
            "batch_id": found,
            "input_path": batch_path(layout.bronze, found),
            "output_path": batch_path(layout.raw, found),
        }

    with monitored(spark, config, locate, layer="raw") as facts:
        rows = 0
        frame = read_bronze(spark, facts["input_path"], config.raw_columns)
        mode = _batch_mode(config, again)
        if not frame.isEmpty() or _stale(spark, facts["output_path"], mode):
            rows = _write_counted(frame, facts["output_path"], mode)
        facts.update(row_count=rows, status="success" if rows else "no_data")
        note(spark, config, facts["batch_id"], "bronze_to_raw", rows, facts["status"])
    return StepResult(facts["status"], facts["output_path"], rows, facts["batch_id"])


def raw_to_tech(
    spark: SparkSession, config: PipelineConfig, batch_id: str | None = None, again: bool = False
) -> StepResult:
    """Newest (or given) RAW batch to TECH and REJECT.

    The batch is read and checked once, into a staged table that is counted as it is written; TECH and REJECT are its two
    parts and are written if they have rows. ``again`` as for ``bronze_to_raw``.
    """
    layout = config.layout

    def locate() -> dict[str, Any]:
        found = batch_id or _newest(spark, config, "bronze_to_raw", layout.raw)
        return {
            "batch_id": found,
            "input_path": batch_path(layout.raw, found),
            "output_path": batch_path(layout.tech, found),
            "reject_path": batch_path(layout.reject, found),
        }

    with monitored(spark, config, locate, layer="tech") as facts:
        raw = spark.read.schema(merged_schema(spark, facts["input_path"])).parquet(facts["input_path"])
        observation = Observation("quality-{}".format(uuid.uuid4().hex))
        mode = _batch_mode(config, again)
        with staged_for_now(spark):
            evaluated = evaluate(raw, config.rules, config.require_columns, config.keep_source, observation)
            evaluated = replace(evaluated, frame=stage(evaluated.frame, "evaluated"))
            valid, rejected = observation.get["valid_rows"], observation.get["rejected_rows"]
            if valid or _stale(spark, facts["output_path"], mode):
                write_parquet(evaluated.valid(), facts["output_path"], mode)
            if rejected or _stale(spark, facts["reject_path"], mode):
                write_parquet(evaluated.rejected(), facts["reject_path"], mode)
        facts.update(
            row_count=valid, rejected_count=rejected, status="success" if valid or rejected else "no_data"
        )
        note(spark, config, facts["batch_id"], "raw_to_tech", valid, facts["status"])
    return StepResult(
        facts["status"], facts["output_path"], valid, facts["batch_id"], facts["reject_path"], rejected
    )


def shape(frame: DataFrame, config: PipelineConfig, existing: DataFrame | None = None) -> DataFrame:
    """TECH rows to FUNC rows: project, derive, enrich, de-duplicate, in this order.

    Metrics are computed before the de-duplication, so they count duplicates.
    """
    frame = project(frame, config.func_columns)
    frame = apply_commands(frame, config.transformations)
    frame = apply_commands(frame, config.enrichments)
    return deduplicate(frame, config.dedup, existing)


def tech_to_func(
    spark: SparkSession, config: PipelineConfig, batch_id: str | None = None, batches: Sequence[str] | None = None
) -> StepResult:
    """Newest (or given) TECH batch, several batches of one run together, or all batches, to FUNC."""
    layout = config.layout
    everything = config.func_scope == "all_batches"

    def locate() -> dict[str, Any]:
        found = sorted(batches) if batches else [batch_id or _newest(spark, config, "raw_to_tech", layout.tech)]
        paths = [layout.tech] if everything else [batch_path(layout.tech, name) for name in found]
        return {"batch_id": found[-1], "input_path": ",".join(paths)}

    about = {
        "layer": "func",
        "output_path": layout.func,
        "write_mode": config.func_mode,
        "dedup_strategy": config.strategy,
    }
    with monitored(spark, config, locate, **about) as facts:
        rows, written = 0, current_path(spark, layout.func)
        paths = facts["input_path"].split(",")
        tech = spark.read.schema(merged_schema(spark, *paths)).parquet(*paths).drop(BATCH_COLUMN)
        if not tech.isEmpty():
            if config.against_existing and config.func_mode == "append":
                # the history de-duplicates the shaped rows against what its buckets hold
                rows, written = append_history(shape(tech, replace(config, dedup=None)), config.dedup, layout.func), rows_path(layout.func)
            elif is_history(spark, layout.func):
                raise ValueError("{} is a history: set deduplication.against_existing or another folder".format(layout.func))
            elif config.func_mode == "overwrite":
                rows, written = _replace_counted(limit_files(shape(tech, config), config.func_partitions), layout.func)
            else:
                rows = _write_counted(limit_files(shape(tech, config), config.func_partitions), written, config.func_mode)
        facts.update(row_count=rows, status="success" if rows else "no_data")
        for name in sorted(batches) if batches else [facts["batch_id"]]:
            note(spark, config, name, "tech_to_func", rows, facts["status"])
    return StepResult(facts["status"], written, rows, facts["batch_id"])


def read_func(spark: SparkSession, config: PipelineConfig) -> DataFrame:
    """FUNC's rows: of its history, or of its newest version."""
    held = read_history(spark, config.layout.func)
    return read_current(spark, config.layout.func) if held is None else held


def func_to_gold(spark: SparkSession, config: PipelineConfig, slots: int | None = None) -> list[StepResult]:
    """FUNC to all dimensions, then all facts, each as a new version. Facts join the dimensions as written, which are read back.

    All are built from the version of FUNC that is the newest when the step begins, or from the runs of a history committed then.
    """
    layout = config.layout
    tables, results = {}, []

    @cache
    def source() -> DataFrame:
        """FUNC, found once: a failure is recorded with the dataset that meets it."""
        return read_func(spark, config)

    by_name = {dimension.name: dimension for dimension in config.dimensions}

    def write(kind: str, item: Any, build: Any) -> str:
        path = layout.gold_table(item.location)
        about = {"dataset_type": kind, "dataset_name": item.name, "input_path": layout.func, "output_path": path}
        with monitored(spark, config, layer="gold", **about) as facts:
            rows, written = _replace_counted(limit_files(build(source()), config.gold_partitions), path)
            facts.update(row_count=rows, status="success" if rows else "no_data")
        results.append(StepResult(facts["status"], written, rows))
        return written

    for dimension in config.dimensions:
        path = write("dimension", dimension, lambda func: build_dimension(func, dimension, slots))
        tables[dimension.name] = spark.read.parquet(path)
    for fact in config.facts:
        write("fact", fact, lambda func: build_fact(func, fact, tables, by_name, slots))
    return results
