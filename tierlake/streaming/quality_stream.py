"""The quality checks over a stream of Bronze JSON lines."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tierlake.operators.quality import ColumnRule, evaluate
from tierlake.sources.staging import stage, staged_for_now
from tierlake.sources.storage import CORRUPT, batch_path, text_schema


def text_stream(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """JSON lines below ``path`` as they arrive; all columns are text, nested values their JSON text.

    Lines that are no JSON are in ``_corrupt_record``.
    """
    reader = spark.readStream.schema(text_schema(columns)).option("columnNameOfCorruptRecord", CORRUPT)
    frame = reader.option("recursiveFileLookup", "true").json(path)
    return frame.withColumns({"_source_file": F.col("_metadata.file_path"), "_raw_loaded_at": F.current_timestamp()})


def start_quality_stream(
    frame: DataFrame,
    rules: Sequence[ColumnRule],
    tech: str,
    reject: str,
    checkpoint: str,
    **options: bool,
) -> StreamingQuery:
    """Check what is new, write TECH and REJECT, and stop.

    A micro-batch is read and evaluated once, into a staged table. Every micro-batch has its own batch folder named after its number, and a replay after a failure overwrites it, so
    each row lands once.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        batch_id = "stream-{:020d}".format(epoch)
        counted = Observation("quality-{}".format(uuid.uuid4().hex))
        with staged_for_now(batch.sparkSession):
            evaluated = evaluate(batch, rules, observation=counted, **options)
            evaluated = replace(evaluated, frame=stage(evaluated.frame, "evaluated"))
            if counted.get["valid_rows"]:
                evaluated.valid().write.mode("overwrite").parquet(batch_path(tech, batch_id))
            if counted.get["rejected_rows"]:
                evaluated.rejected().write.mode("overwrite").parquet(batch_path(reject, batch_id))

    return (
        frame.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
