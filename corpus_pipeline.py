"""From raw documents to a training mixture: quality, exact and near copies, benchmark passages, source weights."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierlake.llm.decontaminate import drop_contaminated
from tierlake.llm.exact_dedup import drop_copies
from tierlake.llm.mixing import mix_sources
from tierlake.llm.near_dedup import drop_near_copies
from tierlake.llm.quality import drop_low_quality
from tierlake.sources.staging import new_folder


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier accepts (score of 0.5 or more)."""
    return drop_low_quality(docs, spark.read.parquet("{}/labels.parquet".format(folder)))


def exact_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents with equal normalised texts the one with the smallest doc_id stays."""
    return drop_copies(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of documents linked by 5-word shingles at a similarity of 0.8 the smallest doc_id stays."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without any window of ten consecutive benchmark words."""
    return drop_contaminated(docs, spark.read.parquet("{}/benchmark.parquet".format(folder)))


def mixing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The order of training: every use of a document, with its source's weight."""
    return mix_sources(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: The quality stage learns a model, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages in order, each written as Parquet and read again by the next."""
    docs = spark.read.parquet("{}/documents.parquet".format(folder))
    for name, stage in STAGES:
        path = new_folder(spark, name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
