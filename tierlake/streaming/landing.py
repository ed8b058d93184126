"""Append-only event sources: a stream that lands what is new and stops."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tierlake.config import PipelineConfig
from tierlake.plans.ledger import note
from tierlake.sources.storage import batch_path, write_jsonl


LINES = ("json", "jsonl", "text")


def read_events(spark: SparkSession, options: dict) -> DataFrame:
    """A stream over an event folder (``location``, ``format``) or a Kafka ``topic`` of a ``broker``.

    JSON lines come as they are, in one column; other file formats need a ``schema``. ``max_files_per_trigger`` and
    ``max_offsets_per_trigger`` cut a backlog into several micro-batches, ``consumer_group`` names the Kafka group. Kafka needs
    its package on the cluster.
    """
    if "topic" in options:
        wanted = {
            "kafka.bootstrap.servers": options["broker"],
            "subscribe": options["topic"],
            "startingOffsets": options.get("starting_offsets", "earliest"),
            "kafka.group.id": options.get("consumer_group"),
            "maxOffsetsPerTrigger": options.get("max_offsets_per_trigger"),
        }
        reader = spark.readStream.format("kafka").options(**{k: str(v) for k, v in wanted.items() if v is not None})
        return reader.load().selectExpr("CAST(key AS string) AS key", "CAST(value AS string) AS value", "topic", "timestamp")
    kind = options.get("format", "json")
    reader = spark.readStream.format("text" if kind in LINES else kind)
    if "max_files_per_trigger" in options:
        reader = reader.option("maxFilesPerTrigger", int(options["max_files_per_trigger"]))
    if kind not in LINES:
        reader = reader.schema(options["schema"])
    return reader.load(options["location"])


def land_events(spark: SparkSession, config: PipelineConfig) -> list[tuple[str, int]]:
    """Land all events that arrived since the last run; returns (batch id, rows) of each micro-batch.

    The checkpoint beside the Bronze folder remembers what was read. A micro-batch is one Bronze batch named after its
    number, so one that is replayed after a failure overwrites itself and lands once. It is in the ledger before the
    checkpoint moves on, so a later run finds it whatever happens to this one.
    """
    landed: list[tuple[str, int]] = []
    lines = "topic" not in config.source.options and config.source.options.get("format", "json") in LINES

    def write(batch: DataFrame, epoch: int) -> None:
        batch_id = "epoch-{:020d}".format(epoch)
        observation = Observation("landed-{}".format(uuid.uuid4().hex))
        counted = batch.observe(observation, F.count(F.lit(1)).alias("rows"))
        write_jsonl(counted, batch_path(config.layout.bronze, batch_id), lines)
        rows = observation.get["rows"]
        note(batch.sparkSession, config, batch_id, "ingest", rows, "success" if rows else "no_data")
        landed.append((batch_id, rows))

    query = (
        read_events(spark, dict(config.source.options))
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", "{}_events_checkpoint".format(config.layout.bronze))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return landed
