from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tierlake.operators.dedup import Dedup, deduplicate
from tierlake.operators.transform import (
    Enrichment,
    Expression,
    Metric,
    OutputColumn,
    apply_commands,
    enrich,
    project,
)


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_project_renames_and_empty_list_keeps_all(spark):
    frame = spark.createDataFrame([(1, 2)], "a int, b int")
    assert project(frame, [OutputColumn("x", "a")]).columns == ["x"]
    assert project(frame, []).columns == ["a", "b"]


def test_expressions_see_earlier_ones(spark):
    frame = spark.createDataFrame([(2,)], "a int")
    done = apply_commands(frame, [Expression("b", "a * 2"), Expression("c", "b + 1")])
    assert done.first().asDict() == {"a": 2, "b": 4, "c": 5}


def test_registered_functions_are_usable(spark):
    spark.udf.register("plus_one", lambda value: value + 1, "int")
    frame = spark.createDataFrame([(2,)], "a int")
    assert apply_commands(frame, [Expression("b", "plus_one(a)")]).first()["b"] == 3


def test_enrichment_keeps_null_groups_with_null_metrics(spark):
    frame = spark.createDataFrame([(1, "g", 5), (2, "g", None), (3, None, 7), (4, "h", None)], "id int, g string, x int")
    metrics = (Metric("n", "count"), Metric("known", "count", "x"), Metric("total", "sum", "x"))
    done = enrich(frame, [Enrichment(("g",), metrics)])
    assert done.columns == ["g", "id", "x", "n", "known", "total"]
    found = {row["id"]: (row["n"], row["known"], row["total"]) for row in done.collect()}
    assert found == {1: (2, 1, 5), 2: (2, 1, 5), 3: (None, None, None), 4: (1, 0, None)}


def test_unknown_aggregate_is_refused(spark):
    with pytest.raises(ValueError, match="No such metric function"):
        enrich(spark.range(1), [Enrichment(("id",), (Metric("m", "median", "id"),))])


def test_small_metrics_are_broadcast_and_rows_not_shuffled(spark):
    frame = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    shown = plan(enrich(frame, [Enrichment(("g",), (Metric("n", "count"),))]))
    assert "BroadcastHashJoin" in shown and "Exchange hashpartitioning" not in shown


def test_large_metrics_with_a_hot_group_are_split(spark, tmp_path):
    """A third of all rows share one group and the metrics are too large to broadcast."""
    rows = spark.range(0, 300_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("pad")
    )
    rows.write.parquet(str(tmp_path / "rows"))
    frame = spark.read.parquet(str(tmp_path / "rows"))
    tuned = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in tuned}
    for key, value in tuned.items():
        spark.conf.set(key, value)
    try:
        done = enrich(frame, [Enrichment(("g",), (Metric("n", "count"),))])
        total = done.groupBy().agg(F.count(F.lit(1)), F.max("n"), F.sum(F.when(F.col("n") == 1, 1)))
        assert tuple(total.first()) == (300_000, 100_000, 200_000)
        done.write.format("noop").mode("overwrite").save()
        done.collect()
        assert "skew=true" in plan(done)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_snapshot_breaks_ties_the_same_way_every_time(spark):
    rows = [(1, 5, "b"), (1, 5, "a"), (1, None, "0"), (2, None, "z"), (None, 1, "n"), (None, 2, "m")]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame(rows, "k int, o int, p string").repartition(3)
        kept = deduplicate(frame, Dedup(("k",), "snapshot", ("o",)))
        assert {tuple(row) for row in kept.collect()} == {(1, 5, "a"), (2, None, "z"), (None, 2, "m")}


def test_snapshot_without_order_is_deterministic(spark):
    frame = spark.createDataFrame([(1, "b"), (1, "a")], "k int, p string")
    assert deduplicate(frame, Dedup(("k",))).first()["p"] == "a"


def test_deduplication_is_idempotent(spark):
    frame = spark.range(200).select((F.col("id") % 7).alias("k"), (F.col("id") % 5).alias("o"))
    dedup = Dedup(("k",), "snapshot", ("o",))
    once = deduplicate(frame, dedup)
    assert sorted(map(tuple, deduplicate(once, dedup).collect())) == sorted(map(tuple, once.collect()))
    assert once.count() == 7


def test_copies_are_dropped_before_the_shuffle(spark):
    frame = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    shown = plan(deduplicate(frame, Dedup(("k",), "snapshot", ("id",))))
    assert shown.count("WindowGroupLimit") == 2 and "Partial" in shown


def test_history_keeps_versions(spark):
    rows = [(1, "a", 1), (1, "a", 2), (1, "b", 3), (2, "a", 1)]
    frame = spark.createDataFrame(rows, "k int, v string, o int")
    dedup = Dedup(("k",), "history", ("o",), hash_column="h", hash_columns=("v",))
    kept = deduplicate(frame, dedup)
    assert {tuple(row)[:3] for row in kept.collect()} == {(1, "a", 2), (1, "b", 3), (2, "a", 1)}
    more = spark.createDataFrame([(1, "a", 9), (1, "c", 9)], "k int, v string, o int")
    assert [row["v"] for row in deduplicate(more, dedup, existing=kept).collect()] == ["c"]
    excluded = deduplicate(frame, Dedup(("k",), "history", hash_exclude=("o",)))
    assert excluded.count() == 3 and excluded.columns == ["k", "v", "o", "hash_data"]


def test_no_configuration_changes_nothing_and_unknown_strategy_fails(spark):
    frame = spark.range(3)
    assert deduplicate(frame, None) is frame
    with pytest.raises(ValueError, match="No such deduplication strategy"):
        deduplicate(frame, Dedup(("id",), "latest"))


def test_rows_with_maps_can_be_deduplicated(spark):
    frame = spark.sql("select 1 as k, map('a', 1) as m, 2 as o union all select 1, map('b', 2), 3")
    assert deduplicate(frame, Dedup(("k",), "snapshot", ("o",))).first()["m"] == {"b": 2}
