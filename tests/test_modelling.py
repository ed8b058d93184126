from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tierlake.operators.dimensions import Dimension, build_dimension, stack_columns
from tierlake.operators.facts import (
    DimensionJoin,
    Fact,
    build_fact,
    lookup,
    lookup_between,
    lookup_sorted,
)
from tierlake.operators.hotkeys import SLOT, neighbour, slotted
from tierlake.operators.transform import OutputColumn
from tierlake.session import DEFAULTS, FORCE_SKEW_SPLIT
from tierlake.sources.staging import stage

MANY = 17


def columns(*names):
    return tuple(OutputColumn(name) for name in names)


def moment(second):
    return None if second is None else dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)


def history(spark, rows):
    return spark.createDataFrame([(key, value, moment(at)) for key, value, at in rows], "k int, v string, t timestamp")


def versioned(**changes):
    base = dict(
        name="d", business_key=("k",), surrogate_key="sk", columns=columns("k", "v", "t"), scd_type=2, valid_from="t",
        tracked=("v",),
    )
    return Dimension(**{**base, **changes})


def test_type_1_drops_null_keys_and_keeps_one_row(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, x int")
    built = build_dimension(frame, Dimension("d", ("k",), "sk", columns("k", "x")))
    assert built.columns == ["k", "x", "sk"] and [tuple(row)[:2] for row in built.collect()] == [("a", 1)]


def test_type_1_of_keys_only_needs_no_sort(spark):
    frame = spark.range(100).select((F.col("id") % 3).alias("k"))
    built = build_dimension(frame, Dimension("d", ("k",), "sk", columns("k")))
    shown = built._jdf.queryExecution().executedPlan().toString()
    assert built.count() == 3 and "Sort" not in shown.replace("SortAgg", "") and "Window" not in shown


def test_roles_are_stacked_in_one_scan(spark):
    frame = spark.createDataFrame([(1, 2), (2, 3), (None, 1)], "a int, b int")
    assert sorted(row[0] or 0 for row in stack_columns(frame, ["a", "b"], "x").collect()) == [0, 1, 1, 2, 2, 3]
    roles = Dimension("d", ("x",), "sk", columns("x"), source_columns=("a", "b"))
    assert sorted(row["x"] for row in build_dimension(frame, roles).collect()) == [1, 2, 3]


def test_type_2_versions_end_one_microsecond_before_the_next(spark):
    built = build_dimension(history(spark, [(1, "a", 0), (1, "a", 5), (1, "b", 10), (2, "a", 3)]), versioned())
    assert built.columns == ["k", "v", "valid_from", "hash_data", "valid_to", "is_current", "sk"]
    rows = {(row["k"], row["v"]): row for row in built.collect()}
    assert rows[1, "a"]["valid_to"] == moment(10) - dt.timedelta(microseconds=1) and not rows[1, "a"]["is_current"]
    assert rows[1, "b"]["valid_to"] is None and rows[1, "b"]["is_current"]
    assert rows[2, "a"]["is_current"] and len({row["sk"] for row in rows.values()}) == 3


def test_a_value_that_returns_opens_no_version_unless_changes_are_asked_for(spark):
    frame = history(spark, [(1, "a", 0), (1, "b", 10), (1, "a", 20)])
    distinct = build_dimension(frame, versioned()).filter("is_current").collect()
    changes = build_dimension(frame, versioned(detect="changes"))
    assert [row["v"] for row in distinct] == ["b"]
    assert changes.count() == 3 and changes.filter("is_current").first()["v"] == "a"


def test_equal_and_missing_starts(spark):
    built = build_dimension(history(spark, [(1, "a", 5), (1, "b", 5), (1, "c", None)]), versioned())
    rows = built.orderBy("hash_data").collect()
    timed = [row for row in rows if row["valid_from"] is not None]
    assert timed[0]["valid_to"] < timed[0]["valid_from"] and timed[1]["valid_to"] is None
    assert sum(row["is_current"] for row in rows) == 2


def test_key_only_versions_need_no_window(spark):
    built = build_dimension(history(spark, [(1, "a", 5), (1, "b", 2)]), versioned(columns=columns("k", "t"), tracked=None))
    row = built.first()
    assert built.count() == 1 and row["valid_from"] == moment(2) and row["is_current"] and row["valid_to"] is None
    assert "Window" not in built._jdf.queryExecution().executedPlan().toString()


def test_unknown_type_is_refused(spark):
    with pytest.raises(ValueError, match="type is 1 or 2"):
        build_dimension(spark.range(1).withColumnRenamed("id", "k"), Dimension("d", ("k",), "sk", columns("k"), scd_type=3))


@pytest.mark.parametrize("following", [True, False])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "bigint", "double", "decimal(9,2)", "string"])
def test_sliced_neighbours_equal_the_plain_window(spark, following, kind):
    picks = random.Random(3)
    rows = [(picks.choice([1, 1, 1, 2, 3]), picks.choice([None, *range(40)]), str(n)) for n in range(150)]
    plain = {k: "cast(o as {})".format(k) for k in ("double", "decimal(9,2)", "string")}
    moments = {**plain, "bigint": "o", "date": "date_add(date'2024-01-01', cast(o as int))"}.get(
        kind, "cast(timestamp_seconds(o * 1000) as {})".format(kind)
    )
    frame = stage(spark.createDataFrame(rows, "k int, o bigint, p string").withColumn("t", F.expr(moments)), "n")
    cut = neighbour(frame, ["k"], ["t", "p"], "p", "other", following, MANY)
    whole = neighbour(frame, ["k"], ["t", "p"], "p", "other", following, 1)
    assert slotted(frame, ["k"], ["t", "p"], MANY).select(SLOT).distinct().count() > 10
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))


@pytest.mark.parametrize("kind", ["timestamp", "double"])
def test_hot_rows_spread_over_slots(spark, kind):
    """Sentinel dates, a burst at one moment and NULL times in a key with a third of all rows."""
    at = "case id % 30 when 0 then -2e9 when 3 then 2e11 when 6 then null when 9 then id else 5e8 end"
    frame = spark.range(12000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"),
        F.expr(at if kind == "double" else "timestamp_seconds({})".format(at)).alias("t"), "id",
    )
    cut = slotted(frame, ["k"], ["t"], 24)
    largest = cut.groupBy(SLOT).count().agg(F.max("count")).first()[0]
    assert cut.count() == 12000 and largest <= 2 * 12000 / 24


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 2), st.sampled_from("abc"), st.integers(0, 20)), min_size=1, max_size=12))
def test_intervals_never_overlap(spark, rows):
    built = build_dimension(history(spark, rows), versioned()).collect()
    spans = defaultdict(list)
    for row in built:
        if row["valid_to"] is None or row["valid_to"] >= row["valid_from"]:
            spans[row["k"]].append((row["valid_from"], row["valid_to"] or dt.datetime.max))
    for found in spans.values():
        found.sort()
        assert all(left[1] < right[0] for left, right in zip(found, found[1:]))
    assert sum(row["is_current"] for row in built) == len({row[0] for row in rows})


DIM_ROWS = [(1, "a", 10), (1, "b", 20), (1, "c", 20), (2, "a", 5), (1, "d", 30), (3, "e", None)]
FACT_ROWS = [
    (1, 1, 5), (2, 1, 10), (3, 1, 19), (4, 1, 20), (5, 1, 99), (6, None, 50), (7, 9, 50), (8, 1, None), (9, 2, 5),
    (10, 3, 50), (11, 1, 30),
]


def _lookup_inputs(spark):
    users = stage(build_dimension(history(spark, DIM_ROWS), versioned()), "dim")
    facts = spark.createDataFrame([(number, key, moment(at)) for number, key, at in FACT_ROWS], "n int, k int, at timestamp")
    return facts, users


@pytest.mark.parametrize("slots", [None, 1, 9])
def test_both_point_in_time_plans_agree_with_a_loop(spark, slots):
    facts, users = _lookup_inputs(spark)
    expected = {}
    known = users.collect()
    for number, key, at in FACT_ROWS:
        hits = [
            row["sk"]
            for row in known
            if row["k"] == key
            and at is not None
            and row["valid_from"] is not None
            and row["valid_from"] <= moment(at)
            and (row["valid_to"] is None or moment(at) <= row["valid_to"])
        ]
        assert len(hits) <= 1
        expected[number] = hits[0] if hits else None
    assert expected[1] is None and expected[2] and expected[4] and expected[8] is None
    direct = lookup_between(facts, users, [("k", "k")], "at", "sk", "out")
    by_order = lookup_sorted(facts, users, [("k", "k")], "at", "sk", "out", slots)
    for found in (direct, by_order):
        assert {row["n"]: row["out"] for row in found.collect()} == expected and found.count() == len(FACT_ROWS)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(1, 2), st.sampled_from("abcdefgh"), st.integers(0, 30)), min_size=1, max_size=16),
    st.lists(st.tuples(st.integers(1, 3), st.integers(-2, 33)), min_size=1, max_size=16),
)
def test_sliced_lookup_equals_direct_lookup(spark, versions, asked):
    users = stage(build_dimension(history(spark, versions), versioned()), "dim")
    rows = [(number, key, moment(at)) for number, (key, at) in enumerate(asked)]
    facts = spark.createDataFrame(rows, "n int, k int, at timestamp")
    direct = lookup_between(facts, users, [("k", "k")], "at", "sk", "out").collect()
    cut = lookup_sorted(facts, users, [("k", "k")], "at", "sk", "out", 11).collect()
    assert sorted(map(str, cut)) == sorted(map(str, direct))


@pytest.mark.parametrize("count", [60, 70])
def test_a_part_of_the_key_finds_every_valid_member(spark, count):
    rows = [(number, "v", 0) for number in range(count)]
    by_group = versioned(business_key=("g", "k"), columns=columns("g", "k", "v", "t"))
    users = stage(build_dimension(history(spark, rows).withColumn("g", F.lit(1)), by_group), "dim")
    facts = spark.createDataFrame([(1, moment(40)), (1, moment(-1))], "g int, t timestamp")
    join = DimensionJoin("d", ("g",), ("g",), "out", "t", fan_out=True)
    found = build_fact(facts, Fact("f", columns("g", "t"), (join,)), {"d": users}, {"d": by_group})
    assert found.count() == count + 1
    refused = Fact("f", columns("g", "t"), (DimensionJoin("d", ("g",), ("g",), "out", "t"),))
    with pytest.raises(ValueError, match="fan_out"):
        build_fact(facts, refused, {"d": users}, {"d": by_group})


def test_a_tracked_time_makes_versions(spark):
    rows = history(spark, [(1, "x", 10), (1, "x", 20), (1, "x", 30)])
    assert build_dimension(rows, versioned(tracked=("v", "t"))).count() == 3
    assert build_dimension(rows, versioned()).count() == 1


def test_fact_keeps_rows_and_default_key_name(spark):
    members = Dimension("d", ("k",), "sk", columns("k"))
    dim = stage(build_dimension(spark.createDataFrame([(1,), (2,)], "k int"), members), "dim")
    facts = spark.createDataFrame([(1, 2, 7.0), (None, 5, 8.0)], "a int, b int, m double")
    fact = Fact(
        "f",
        (*columns("a", "b"), OutputColumn("twice", expression="m * 2")),
        (DimensionJoin("d", ("a",), ("k",)), DimensionJoin("d", ("b",), ("k",), "b_key")),
    )
    built = build_fact(facts, fact, {"d": dim}, {"d": members})
    assert built.columns == ["a", "b", "twice", "sk", "b_key"]
    rows = {row["b"]: row for row in built.collect()}
    assert rows[2]["sk"] and rows[2]["b_key"] and rows[5]["sk"] is None and rows[5]["b_key"] is None


def test_versions_without_a_time_fan_out(spark):
    _, users = _lookup_inputs(spark)
    facts = spark.createDataFrame([(1,), (2,), (9,)], "k int")
    with pytest.raises(ValueError, match="fan_out"):
        build_fact(facts, Fact("f", columns("k"), (DimensionJoin("d", ("k",), ("k",)),)), {"d": users}, {"d": versioned()})
    fact = Fact("f", columns("k"), (DimensionJoin("d", ("k",), ("k",), fan_out=True),))
    assert build_fact(facts, fact, {"d": users}, {"d": versioned()}).count() == 4 + 1 + 1


def test_unequal_key_lists_are_refused(spark):
    fact = Fact("f", columns("k"), (DimensionJoin("d", ("k",), ("k", "v")),))
    with pytest.raises(ValueError, match="as many"):
        build_fact(spark.createDataFrame([(1,)], "k int"), fact, {}, {"d": versioned()})


def test_a_hot_key_is_split_even_when_two_lookups_share_it(spark):
    """A third of all fact rows has one key, and both dimensions are too large to broadcast."""
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k")
    text = F.sha2(F.col("id").cast("string"), 256)
    facts = stage(spark.range(0, 300_000, 1, 12).select(key, text.alias("pad")), "facts")
    members = stage(spark.range(-1, 300_000).select(F.col("id").alias("k"), text.alias("sk"), F.col("id").alias("n")), "dim")
    tuned = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
        "spark.sql.shuffle.partitions": "16",
        FORCE_SKEW_SPLIT: DEFAULTS[FORCE_SKEW_SPLIT],
    }
    before = {name: spark.conf.get(name, None) for name in tuned}
    for name, value in tuned.items():
        spark.conf.set(name, value)
    try:
        once = lookup(facts, members, [("k", "k")], "sk", "first")
        twice = lookup(once, members, [("k", "k")], "n", "second")
        rows = twice.collect()
        shown = twice._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert len(rows) == 300_000 and all(row["k"] == row["second"] for row in rows)
        assert shown.count("skew=true") == 2
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
