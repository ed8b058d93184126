from __future__ import annotations

import datetime as dt
import json
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tierlake.config import parse_config
from tierlake.plans import jobs
from tierlake.plans.jobs import run_all
from tierlake.plans.layers import bronze_to_raw, func_to_gold, ingest, raw_to_tech, read_func, tech_to_func
from tierlake.sources.catalog import mirror
from tierlake.sources.versions import read_current
from tierlake.sources.storage import batch_ids, path_exists, read_bronze
from tierlake.streaming.quality_stream import start_quality_stream, text_stream
from tierlake.operators.quality import ColumnRule

TECH = {
    "bucket": "lake",
    "prefix": "s/silver/tech",
    "columns": [
        {"name": "id", "type": "integer", "check_nullability": True, "is_critical": True},
        {"name": "amount", "type": "double", "fill_nulls": 0, "check_range": {"min": 0}},
        {"name": "at", "type": "timestamp"},
    ],
}


def configuration(root, location, **changes):
    func = {
        "bucket": "lake",
        "prefix": "s/silver/func",
        "columns": [{"name": "id"}, {"name": "shop"}, {"name": "amount"}, {"source": "at", "name": "sold_at"}],
        "enrichments": [
            {"type": "aggregate", "group_by": ["shop"], "metrics": [{"name": "shop_sales", "function": "count"}]}
        ],
        "deduplication": {"keys": ["id"], "order_by": ["sold_at"], **changes.pop("dedup", {})},
        **changes.pop("func", {}),
    }
    document = {
        "pipeline": {"name": "sales"},
        "source": {"type": "file", "format": "jsonl", "location": str(location)},
        "bronze": {"bucket": "lake", "prefix": "s/bronze"},
        "silver": {
            "raw": {"bucket": "lake", "prefix": "s/silver/raw", **changes.pop("raw", {})},
            "tech": {**TECH, **changes.pop("tech", {})},
            "func": func,
        },
        "gold": {
            "bucket": "lake",
            "prefix": "s/gold",
            "dimensions": [
                {
                    "name": "dim_shop",
                    "path": "dimensions/dim_shop",
                    "business_key": ["shop"],
                    "surrogate_key": "shop_key",
                    "columns": [{"name": "shop"}, {"name": "sold_at"}],
                    "scd": {"type": 2, "valid_from": "sold_at"},
                }
            ],
            "facts": [
                {
                    "name": "fact_sale",
                    "path": "facts/fact_sale",
                    "columns": [{"name": "id"}, {"name": "shop"}, {"name": "sold_at"}, {"name": "amount"}],
                    "joins": [
                        {
                            "dimension": "dim_shop",
                            "source_key": ["shop"],
                            "target_key": ["shop"],
                            "effective_at": "sold_at",
                        }
                    ],
                }
            ],
        },
        **changes,
    }
    return parse_config(document, root)


def drop(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(row) + "\n" for row in rows))


ROWS = [
    {"id": 1, "shop": "a", "amount": 5, "at": "2024-01-01T10:00:00"},
    {"id": 1, "shop": "a", "amount": 6, "at": "2024-01-01T11:00:00"},
    {"id": 2, "shop": "b", "amount": None, "at": "2024-01-01T12:00:00"},
    {"id": None, "shop": "b", "amount": 1, "at": "2024-01-01T12:00:00"},
    {"id": 3, "shop": None, "amount": -1, "at": "2024-01-01T12:00:00"},
]


def events(spark, config, layer):
    frame = spark.read.parquet("{}/{}".format(config.layout.monitoring, layer)).orderBy("event_timestamp")
    return [tuple(row) for row in frame.select("status", "row_count").collect()]


def test_two_batches_end_to_end(spark, root, tmp_path):
    config = configuration(root, tmp_path / "drop")
    drop(tmp_path / "drop", "one.jsonl", ROWS)
    outcome = run_all(spark, config, "20240101T000000Z")
    assert outcome["func_to_gold"] == "success"
    func = {row["id"]: row for row in read_current(spark, config.layout.func).collect()}
    assert set(func) == {1, 2} and func[1]["amount"] == 6.0 and func[2]["amount"] == 0.0
    assert func[1]["shop_sales"] == 2, "metrics are computed before the de-duplication"
    reject = spark.read.parquet(config.layout.reject)
    assert {row["rejected_fields"] for row in reject.collect()} == {"id", "amount"}
    fact = read_current(spark, config.layout.gold_table("facts/fact_sale"))
    assert fact.count() == 2 and fact.filter("shop_key is null").count() == 0
    assert "gold.fact_sale" in outcome["catalog"] and "monitoring.gold_fact_sale_events" in outcome["catalog"]
    assert spark.table("silver.reject_sales").filter("ingestion_timestamp = '20240101T000000Z'").count() == 2

    drop(tmp_path / "drop", "one.jsonl", [{"id": 9, "shop": "c", "amount": 1, "at": "2024-01-02T10:00:00", "new": "x"}])
    run_all(spark, config, "20240102T000000Z")
    assert batch_ids(spark, config.layout.tech) == ["20240101T000000Z", "20240102T000000Z"]
    assert [row["id"] for row in read_current(spark, config.layout.func).collect()] == [9]
    assert spark.table("silver.tech_sales").count() == 4 and "new" in spark.table("silver.tech_sales").columns
    assert events(spark, config, "tech") == [("started", 0), ("success", 3), ("started", 0), ("success", 1)]
    gold = spark.read.parquet(config.layout.monitoring + "/gold/facts/fact_sale")
    assert gold.columns[3] == "status" and gold.filter("status = 'success'").count() == 2


def test_all_batches_scope_reads_every_batch(spark, root, tmp_path):
    config = configuration(root, tmp_path / "drop", func={"scope": "all_batches"})
    drop(tmp_path / "drop", "one.jsonl", ROWS)
    run_all(spark, config, "20240101T000000Z", with_catalog=False)
    drop(tmp_path / "drop", "one.jsonl", [{"id": 1, "shop": "z", "amount": 1, "at": "2024-01-02T10:00:00"}])
    run_all(spark, config, "20240102T000000Z", with_catalog=False)
    assert {row["id"]: row["shop"] for row in read_current(spark, config.layout.func).collect()} == {1: "z", 2: "b"}


def test_empty_and_rejected_batches_stop_the_chain(spark, root, tmp_path):
    config = configuration(root, tmp_path / "drop")
    drop(tmp_path / "drop", "one.jsonl", ROWS[:1])
    run_all(spark, config, "20240101T000000Z", with_catalog=False)
    drop(tmp_path / "drop", "one.jsonl", [{"id": "x", "shop": "a", "amount": 1, "at": None}])
    outcome = run_all(spark, config, "20240102T000000Z", with_catalog=False)
    assert outcome == {"ingest": "success", "bronze_to_raw": "success", "raw_to_tech": "success"}
    assert not path_exists(spark, config.layout.tech + "/ingestion_timestamp=20240102T000000Z")
    assert tech_to_func(spark, config).batch_id == "20240101T000000Z", "a single step takes the newest stored batch"
    drop(tmp_path / "drop", "one.jsonl", [])
    declared = configuration(
        root, tmp_path / "drop", source={
            "type": "file", "format": "jsonl", "location": str(tmp_path / "drop"), "schema_mode": "declared",
            "schema": "id string",
        }
    )
    assert run_all(spark, declared, "20240103T000000Z", with_catalog=False) == {"ingest": "no_data"}
    assert bronze_to_raw(spark, declared).status == "no_data"


@pytest.mark.parametrize("mode, expected", [("append", 6), ("replace", 3)])
def test_running_a_batch_again(spark, root, tmp_path, mode, expected):
    config = configuration(root, tmp_path / "drop", batch_write=mode)
    drop(tmp_path / "drop", "one.jsonl", ROWS)
    ingest(spark, config, "20240101T000000Z")
    bronze_to_raw(spark, config)
    raw_to_tech(spark, config)
    assert raw_to_tech(spark, config).rows == 3
    assert spark.read.parquet(config.layout.tech).count() == expected


def test_history_appends_only_new_versions_when_asked(spark, root, tmp_path):
    hashing = {"strategy": "history", "hash": {"columns": ["shop"]}}
    for against, expected in ((False, 4), (True, 2)):
        base = "{}{}/".format(root, against)
        config = configuration(base, tmp_path / "drop", dedup={**hashing, "against_existing": against})
        drop(tmp_path / "drop", "one.jsonl", ROWS[:3])
        for batch in ("20240101T000000Z", "20240102T000000Z"):
            for step in (ingest, bronze_to_raw, raw_to_tech, tech_to_func):
                step(spark, config, batch)
        assert read_func(spark, config).count() == expected
        assert [result.status for result in func_to_gold(spark, config)] == ["success", "success"]
        assert read_current(spark, config.layout.gold_table("facts/fact_sale")).count() == expected
    for _ in range(2):
        assert config.func_table in [name.removeprefix("silver.") for name in mirror(spark, config)]
    shown = spark.table("silver." + config.func_table)
    assert shown.count() == 2 and shown.columns == read_func(spark, config).columns
    plain = configuration(base, tmp_path / "drop", dedup=hashing)
    with pytest.raises(ValueError, match="is a history"):
        tech_to_func(spark, plain, "20240102T000000Z")


def test_failures_are_recorded_and_raised(spark, root, tmp_path):
    config = configuration(root, tmp_path / "nowhere")
    with pytest.raises(ValueError, match="no dataset at"):
        raw_to_tech(spark, config)
    row = spark.read.parquet(config.layout.monitoring + "/tech").filter("status = 'failed'").first()
    assert row["error_type"] == "ValueError" and "no dataset at" in row["error_message"]
    with pytest.raises(Exception):
        func_to_gold(spark, config)
    assert spark.read.parquet(config.layout.monitoring + "/gold/dimensions/dim_shop").count() == 2
    with pytest.raises(Exception):
        ingest(spark, config)
    assert [status for status, _ in events(spark, config, "bronze")] == ["started", "failed"]


def test_gold_writes_even_without_rows(spark, root, tmp_path):
    config = configuration(root, tmp_path / "drop")
    spark.createDataFrame([], "id int, shop string, amount double, sold_at timestamp").write.parquet(config.layout.func)
    assert [result.status for result in func_to_gold(spark, config)] == ["no_data", "no_data"]
    assert read_current(spark, config.layout.gold_table("dimensions/dim_shop")).count() == 0
    assert "gold.dim_shop" in mirror(spark, config)


def test_event_source_lands_only_what_is_new(spark, root, tmp_path):
    source = {
        "type": "events", "location": str(tmp_path / "drop"), "format": "jsonl",
        "schema": "id string, shop string, amount string, at string",
    }
    config = configuration(root, tmp_path / "drop", source=source)
    drop(tmp_path / "drop", "one.jsonl", ROWS[:2])
    assert run_all(spark, config, with_catalog=False)["func_to_gold"] == "success"
    drop(tmp_path / "drop", "two.jsonl", ROWS[2:3])
    run_all(spark, config, with_catalog=False)
    assert run_all(spark, config, with_catalog=False) == {"ingest": "no_data"}
    assert batch_ids(spark, config.layout.bronze) == ["epoch-{:020d}".format(number) for number in (0, 1)]
    assert spark.read.parquet(config.layout.tech).count() == 3


def test_a_landed_batch_is_finished_by_the_next_run(spark, root, tmp_path):
    source = {"type": "events", "location": str(tmp_path / "drop"), "format": "jsonl"}
    config = configuration(root, tmp_path / "drop", source=source)
    drop(tmp_path / "drop", "one.jsonl", ROWS[:1])
    ingest(spark, config)  # the run ends here
    drop(tmp_path / "drop", "two.jsonl", ROWS[2:3])
    assert run_all(spark, config, with_catalog=False)["func_to_gold"] == "success"
    assert {row["id"] for row in read_current(spark, config.layout.func).collect()} == {1, 2}
    assert read_current(spark, config.layout.gold_table("facts/fact_sale")).count() == 2


def test_a_failure_in_the_middle_is_made_good(spark, root, tmp_path, monkeypatch):
    config = configuration(root, tmp_path / "drop")
    drop(tmp_path / "drop", "one.jsonl", ROWS)

    def broken(*_, **__):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr("tierlake.plans.layers.evaluate", broken)
        with pytest.raises(RuntimeError):
            run_all(spark, config, "20240101T000000Z", with_catalog=False)
    drop(tmp_path / "drop", "one.jsonl", [{"id": 7, "shop": "c", "amount": 1, "at": "2024-01-02T10:00:00"}])
    run_all(spark, config, "20240102T000000Z", with_catalog=False)
    assert {row["id"] for row in read_current(spark, config.layout.func).collect()} == {1, 2, 7}
    assert spark.read.parquet(config.layout.raw).count() == 6 and spark.read.parquet(config.layout.tech).count() == 4


def test_malformed_lines_reach_reject(spark, root, tmp_path):
    for mode in ({}, {"schema_mode": "declared", "columns": [{"name": n} for n in ("id", "shop", "amount", "at")]}):
        base = "{}{}/".format(root, len(mode))
        source = {"type": "events", "location": str(tmp_path / "drop"), "format": "jsonl"}
        config = configuration(base, tmp_path / "drop", source=source, raw=mode)
        drop(tmp_path / "drop", "one.jsonl", ROWS[:1])
        (tmp_path / "drop" / "bad.jsonl").write_text("{bad line\n")
        run_all(spark, config, with_catalog=False)
        reject = spark.read.parquet(config.layout.reject).collect()
        assert [row["_corrupt_record"] for row in reject] == ["{bad line"] and read_current(spark, config.layout.func).count() == 1


def test_a_batch_is_read_and_checked_once(spark, root, tmp_path):
    config = configuration(root, tmp_path / "drop", dedup={})
    drop(tmp_path / "drop", "one.jsonl", ROWS)
    ingest(spark, config, "20240101T000000Z")
    bronze_to_raw(spark, config)
    seen = spark.sparkContext.accumulator(0)

    def counted(text):
        seen.add(1)
        return text

    spark.udf.register("seen_once", counted)
    raw = config.layout.raw + "/ingestion_timestamp=20240101T000000Z"
    import tierlake.plans.layers as layers

    evaluate = layers.evaluate
    try:
        layers.evaluate = lambda frame, *rest: evaluate(frame.withColumn("shop", F.expr("seen_once(shop)")), *rest)
        result = raw_to_tech(spark, config)
    finally:
        layers.evaluate = evaluate
    assert (result.rows, result.rejected) == (3, 2) and seen.value == spark.read.parquet(raw).count() == 5


def test_one_file_of_many_configurations(spark, root, tmp_path, monkeypatch):
    ran = []
    monkeypatch.setattr(jobs, "build_session", lambda *_: spark)
    monkeypatch.setattr(jobs, "drop_staged", lambda *_: None)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    monkeypatch.setattr(jobs, "run_step", lambda spark, config, *_: ran.append(config.name) or 1 / (config.name == "events"))
    pattern = str(Path(__file__).resolve().parent.parent / "configs" / "*.yml")
    with pytest.raises(SystemExit, match="orders"):
        jobs.main(["all", "--config", pattern, "--root", root])
    assert ran == ["events", "orders"]


def test_quality_stream_lands_each_row_once(spark, root, tmp_path):
    rules = [ColumnRule("id", "integer", required=True)]
    for name, rows in (("one.jsonl", ROWS[:4]), ("two.jsonl", ROWS[4:])):
        drop(tmp_path / "drop", name, rows)
        stream = text_stream(spark, str(tmp_path / "drop"), ["id", "shop"])
        start_quality_stream(stream, rules, root + "tech", root + "reject", root + "ck").awaitTermination()
    assert spark.read.parquet(root + "tech").count() == 4 and spark.read.parquet(root + "reject").count() == 1


def test_a_table_resumes_at_its_last_value(spark, root):
    """Rows that tie with the last value land once each, however late they come; equal rows are counted."""
    source = {"type": "table", "table": "growing_rows", "incremental_column": "at"}
    config = configuration(root, "", source=source)
    schema = "at timestamp_ntz, id int, text string, `odd name` double"
    rows = lambda *items: [(dt.datetime(2024, 1, day, 3, 4, 5, 123456), i, text, 0.1) for day, i, text in items]
    first = rows((1, 1, "a"), (2, 2, None), (2, 3, "c"), (2, 3, "c"))
    steps = [
        (first, 4),
        (first, 0),
        (first + rows((2, 4, "late"), (2, 3, "c"), (1, 9, "too late")), 2),
        (first + rows((2, 4, "late"), (2, 3, "c"), (2, 5, "later"), (3, 6, "new")), 2),
        (first + rows((2, 7, "past the mark"), (3, 6, "new"), (3, 6, "new"), (3, 8, None)), 2),
    ]
    landed = []
    for number, (held, wanted) in enumerate(steps):
        spark.createDataFrame(held, schema).repartition(3).createOrReplaceTempView("growing_rows")
        run = ingest(spark, config, "2024010{}T000000Z".format(number + 1))
        assert run.rows == wanted, number
        landed += [(r["id"], r["text"]) for r in read_bronze(spark, run.path).collect()] if wanted else []
    assert Counter(landed) == {("1", "a"): 1, ("2", None): 1, ("3", "c"): 3, ("4", "late"): 1, ("5", "later"): 1, ("6", "new"): 2, ("8", None): 1}
