"""Connected components of links between documents, by alternating star operations on staged tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tierlake.sources.staging import stage

MAX_ROUNDS = 60


def _staged(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The stored edges with their count and an order-free checksum, taken as they are written."""
    state = Observation("edges-{}".format(uuid.uuid4().hex))
    hashed = F.sum(F.xxhash64("node", "root").cast("decimal(38,0)")).alias("hash")
    stored = stage(edges.observe(state, F.count(F.lit(1)).alias("rows"), hashed), "edges")
    return stored, (state.get["rows"], state.get["hash"] or 0)


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) for every node of ``links`` (``a``, ``b``) that isn't its own root.

    Each round hangs the larger neighbours of a node, then the smaller ones, below its smallest neighbour; stars are reached
    after a number of rounds that grows with the logarithm of the longest path. A node with very many links is reduced by
    ``min`` before the shuffle, and its rows are joined with one row. Loops and repeated links don't matter.
    """
    edges = links.filter("a != b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct()
    edges, before = _staged(edges)
    for _ in range(MAX_ROUNDS):
        both = edges.select(F.col("root").alias("u"), F.col("node").alias("v")).unionByName(
            edges.select(F.col("node").alias("u"), F.col("root").alias("v"))
        )
        lowest = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("node"), F.col("m").alias("root"))
        least = large.groupBy("node").agg(F.min("root").alias("m"))
        small = large.join(least, "node")
        edges = small.select("node", F.col("m").alias("root")).unionByName(
            small.filter("root != m").select(F.col("root").alias("node"), F.col("m").alias("root"))
        )
        edges, after = _staged(edges.distinct())
        if after == before:
            return edges
        before = after
    raise RuntimeError("Components did not settle within {} rounds".format(MAX_ROUNDS))
