from __future__ import annotations

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Observation, functions as F

from tierlake.operators.quality import ColumnRule, evaluate, split

RULES = (
    ColumnRule("a", "integer", required=True),
    ColumnRule("b", "double", minimum=0, maximum=10, fill=0.0),
    ColumnRule("c", "string", accepted=("x", "y")),
)
SCHEMA = "a string, b string, c string, d string"


def test_reasons_follow_column_order_and_first_check_wins(spark):
    rows = [("1", "5", "x", "k"), ("q", "99", "z", "k"), (" ", "-1", None, ""), ("2", "zz", "y", None)]
    valid, rejected = split(spark.createDataFrame(rows, SCHEMA), RULES)
    assert [tuple(row) for row in valid.collect()] == [(1, 5.0, "x", "k")]
    found = {row["rejected_fields"]: row for row in rejected.collect()}
    assert set(found) == {"a,b,c", "a,b", "b"}
    assert found["a,b,c"]["rejection_reason"] == (
        "field=a; check=unexpected_value; reason=cast_failed; field=b; check=unexpected_value; reason=above_maximum; "
        "field=c; check=unexpected_value; reason=not_accepted"
    )
    assert found["a,b"]["rejection_reason"] == (
        "field=a; check=unexpected_null; reason=required_field_missing; "
        "field=b; check=unexpected_value; reason=below_minimum"
    )
    assert found["b"]["b"] == 0.0 and found["b"]["rejection_stage"] == "tech"
    assert rejected.columns == ["a", "b", "c", "d", "rejection_reason", "rejected_fields", "rejection_stage", "rejected_at"]


def test_fill_never_saves_a_required_field(spark):
    frame = spark.createDataFrame([("",)], "v string")
    valid, rejected = split(frame, [ColumnRule("v", "integer", required=True, fill=7)])
    assert valid.count() == 0 and rejected.first()["v"] == 7


def test_nan_passes_a_minimum_and_fails_a_maximum(spark):
    frame = spark.createDataFrame([("NaN",)], "v string")
    assert split(frame, [ColumnRule("v", "double", minimum=0)])[0].count() == 1
    assert split(frame, [ColumnRule("v", "double", maximum=10)])[1].count() == 1


def test_accepted_values_are_compared_in_the_declared_type(spark):
    frame = spark.createDataFrame([("1",), ("3",), (None,)], "v string")
    valid, rejected = split(frame, [ColumnRule("v", "integer", accepted=("1", "2"))])
    assert [row[0] for row in valid.orderBy("v").collect()] == [None, 1]
    assert rejected.first()["rejection_reason"].endswith("not_accepted")


def test_missing_columns_are_ignored_unless_required(spark):
    frame = spark.createDataFrame([("1",)], "v string")
    rules = [ColumnRule("v", "integer"), ColumnRule("w", "integer", required=True)]
    assert split(frame, rules)[0].columns == ["v"]
    valid, rejected = split(frame, rules, require_columns=True)
    assert valid.count() == 0 and rejected.first()["rejected_fields"] == "w"


def test_nested_values_become_text(spark, tmp_path):
    path = tmp_path / "nested.jsonl"
    path.write_text('{"v": {"type": "Point", "at": [1.5, 2]}}\n')
    frame = spark.read.option("primitivesAsString", "true").json(str(path))
    assert split(frame, [])[0].first()["v"] == "{[1.5, 2], Point}"


def test_source_text_is_kept_on_request(spark):
    frame = spark.createDataFrame([("q", "5", "x", "k")], SCHEMA)
    rejected = split(frame, RULES, keep_source=True)[1].first()
    assert rejected["source_values"] == {"a": "q"} and rejected["a"] is None


def test_one_action_counts_both_sides(spark):
    observation = Observation("counts")
    frame = spark.range(100).select(F.col("id").cast("string").alias("v"))
    evaluated = evaluate(frame, [ColumnRule("v", "integer", maximum=59)], observation=observation)
    assert evaluated.valid().count() == 60
    assert observation.get == {"valid_rows": 60, "rejected_rows": 40}


def test_checks_run_once_per_row(spark):
    """The split filter stays above the casts, so the plan holds each cast once."""
    frame = spark.createDataFrame([("1", "2", "x", "k")], SCHEMA)
    plan = split(frame, RULES)[0]._jdf.queryExecution().executedPlan().toString()
    assert "CollectMetrics" in plan and plan.count("try_cast(__text_b") <= 1 and "Exchange" not in plan


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[st.one_of(st.none(), st.text("0129.-x ", max_size=4)) for _ in range(4)]), max_size=8))
def test_split_loses_nothing(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    valid, rejected = split(frame, RULES)
    assert valid.count() + rejected.count() == len(rows)
    assert rejected.filter("rejection_reason = '' or rejected_fields = ''").count() == 0
