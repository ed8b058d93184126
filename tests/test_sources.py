from __future__ import annotations

import datetime as dt
import json
import sys
import uuid
from pathlib import Path
from urllib.error import HTTPError

import pytest
from pyspark import cloudpickle

from tierlake.sources import paged
from tierlake.sources.catalog import identifier, register_table
from tierlake.sources.staging import drop_staged, stage, staged_for_now
from tierlake.sources.storage import (
    batch_ids,
    between,
    has_parquet,
    latest_batch,
    limit_files,
    merged_schema,
    path_exists,
    read_bronze,
    reject_prefix,
    write_jsonl,
)


def test_latest_batch_is_the_greatest_text(spark, root):
    base = root + "data"
    for name in ("0123", "20240101T000000Z", "20240102T000000Z"):
        spark.range(1).write.parquet("{}/ingestion_timestamp={}".format(base, name))
    spark.range(1).write.parquet(base + "/other=99999999T000000Z")
    assert batch_ids(spark, base)[0] == "0123" and latest_batch(spark, base) == "20240102T000000Z"
    with pytest.raises(ValueError, match="no batch folder"):
        latest_batch(spark, base + "/other=99999999T000000Z")
    with pytest.raises(ValueError, match="no dataset at"):
        latest_batch(spark, root + "nowhere")


def test_parquet_is_found_at_any_depth(spark, root):
    spark.range(1).write.parquet(root + "a/b/c")
    spark.range(1).write.json(root + "j")
    assert has_parquet(spark, root + "a") and not has_parquet(spark, root + "j") and not has_parquet(spark, root + "x")
    assert path_exists(spark, root + "j")


def test_reject_prefix():
    assert reject_prefix("x/silver/tech/tech") == "x/silver/reject/tech"
    with pytest.raises(ValueError, match="set silver.reject"):
        reject_prefix("x/technical")


def test_bronze_is_text_with_nested_values(spark, tmp_path):
    (tmp_path / "data.jsonl").write_text('{"a": 1, "b": {"c": [1.5, 2]}}\nnot json\n{"a": true, "é": "ü"}\n')
    frame = read_bronze(spark, "file://{}".format(tmp_path))
    kinds = dict(frame.dtypes)
    assert kinds["a"] == "string" and kinds["b"] == "struct<c:array<string>>" and kinds["_raw_loaded_at"] == "timestamp"
    assert frame.cache().filter("_corrupt_record is not null").first()["_corrupt_record"] == "not json"
    assert frame.first()["_source_file"].endswith("data.jsonl")
    declared = read_bronze(spark, "file://{}".format(tmp_path), ["a", "b"]).cache()
    assert declared.filter("_corrupt_record is not null").first()["_corrupt_record"] == "not json"
    assert declared.filter("a = '1'").first()["b"] == '{"c": [1.5, 2]}'


def test_json_lines_keep_microseconds_and_nulls(spark, root):
    frame = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179575), None)], "t timestamp_ntz, n int")
    write_jsonl(frame, root + "j")
    assert spark.read.text(root + "j").first()[0] == '{"t":"2024-01-01T00:00:07.179575","n":null}'


def test_range_reaches_the_files(spark, root):
    spark.range(100).write.parquet(root + "r")
    frame = between(spark.read.parquet(root + "r"), "id", 10, 19)
    assert frame.count() == 10
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id,10), LessThanOrEqual(id,19)]" in (
        frame._jdf.queryExecution().executedPlan().toString()
    )


def test_number_of_files_is_capped(spark, root):
    limit_files(spark.range(100).repartition(7), 2).write.parquet(root + "f")
    assert len(spark.read.parquet(root + "f").inputFiles()) == 2
    frame = spark.range(3)
    assert limit_files(frame, None) is frame


def test_staged_tables_can_be_dropped(spark):
    kept = stage(spark.range(3), "gone")
    folder = kept.inputFiles()[0].rsplit("/", 1)[0]
    assert path_exists(spark, folder)
    drop_staged(spark)
    assert not path_exists(spark, folder)


def test_staged_tables_go_with_their_scope(spark):
    outside = stage(spark.range(2), "outside")
    with staged_for_now(spark):
        with staged_for_now(spark):
            pass
        inside = stage(spark.range(3), "inside").inputFiles()[0].rsplit("/", 1)[0]
        assert path_exists(spark, inside)
    assert not path_exists(spark, inside) and outside.count() == 2


def test_staged_tables_keep_schema_and_rows(spark):
    frame = spark.sql("select 1 as a, 'x' as b, map('k', 2) as m, timestamp_ntz'2024-01-01' as t")
    kept = stage(frame, "kept")
    assert kept.schema.simpleString() == frame.schema.simpleString() and kept.collect() == frame.collect()


def test_retries_stop_on_success_and_on_lasting_errors():
    pauses, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise paged.TransientError("busy", 503)
        return "done"

    assert paged.with_retries(flaky, 5, pauses.append) == "done" and pauses == [1, 2]
    with pytest.raises(paged.TransientError):
        paged.with_retries(lambda: (_ for _ in ()).throw(paged.TransientError("busy", 429)), 2, pauses.append)
    assert pauses == [1, 2, 1, 2]
    with pytest.raises(paged.TransientError):
        paged.with_retries(lambda: (_ for _ in ()).throw(paged.TransientError("gone", 404)), 5, pauses.append)
    assert pauses == [1, 2, 1, 2]
    long = []
    with pytest.raises(ConnectionError):
        paged.with_retries(lambda: (_ for _ in ()).throw(ConnectionError()), 8, long.append)
    assert long == [1, 2, 4, 8, 16, 32, 60, 60]


class Counting:
    """Rows 0 .. n - 1; every request leaves a file, so that requests on workers can be counted."""

    def __init__(self, options):
        self.options = options

    def fetch(self, offset, limit):
        Path(self.options["location"], "{}-{}".format(offset, uuid.uuid4().hex)).write_text("")
        for number in range(offset, min(offset + limit, int(self.options["rows"]))):
            yield {"id": number, "where": {"at": [1.5, number]}}


def _read(spark, location, rows, size, most, schema="id string", **options):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    paged.register_transport("counting", Counting)
    paged.register(spark)
    options = {"transport": "counting", "location": str(location), "rows": rows, "page_size": size, "max_rows": most, **options}
    return spark.read.format("paged").schema(schema).options(**options).load()


def asked(folder):
    return sorted(int(path.name.split("-")[0]) for path in folder.iterdir())


@pytest.mark.parametrize("rows, most, expected", [(95, 1000, 95), (95, 25, 25), (90, 1000, 90), (0, 1000, 0), (7, 3, 3)])
def test_readers_stop_at_the_end(spark, tmp_path, rows, most, expected):
    frame = _read(spark, tmp_path, rows, 10, most)
    assert frame.rdd.getNumPartitions() == min(4, -(-most // 10))
    found = [int(row[0]) for row in frame.collect()]
    assert sorted(found) == list(range(expected))
    beyond = [offset for offset in asked(tmp_path) if offset >= rows]
    assert len(beyond) <= 4 and len(asked(tmp_path)) == len(set(asked(tmp_path)))


def test_readers_and_pauses_are_options(spark, tmp_path):
    frame = _read(spark, tmp_path, 30, 10, 30, readers=1, page_pause_seconds=0.01, schema="value string")
    assert frame.rdd.getNumPartitions() == 1 and json.loads(frame.first()[0]) == {"id": 0, "where": {"at": [1.5, 0]}}
    with pytest.raises(Exception, match="above 0"):
        _read(spark, tmp_path, 1, 0, 1).count()


class FakeResponse:
    def __init__(self, body):
        self.body = body

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return False

    def read(self):
        return self.body


def test_http_pages_carry_range_limit_and_offset():
    asked = []

    def opener(url, timeout):
        asked.append((url, timeout))
        return FakeResponse(b'[{"a": 1}]')

    options = {
        "endpoint": "http://source/rows.json", "request_timeout_seconds": "9", "filter_column": "at",
        "filter_start": "2023-01-01", "filter_end": "2023-02-01",
    }
    assert list(paged.HttpTransport(options, opener).fetch(20, 10)) == [{"a": 1}]
    url, timeout = asked[0]
    assert timeout == 9 and url == (
        "http://source/rows.json?%24limit=10&%24offset=20&%24order=%3Aid&%24where=at+between+%272023-01-01%27+and+%272023-02-01%27"
    )


def test_http_errors_are_transient_or_lasting():
    def failing(status):
        def opener(url, timeout):
            raise HTTPError(url, status, "no", None, None)

        return opener

    for status, transient in ((503, True), (429, True), (404, False)):
        with pytest.raises(paged.TransientError) as caught:
            list(paged.HttpTransport({"endpoint": "http://source"}, failing(status)).fetch(0, 1))
        assert paged.is_transient(caught.value) is transient


def test_identifiers():
    assert identifier("RAW Trips-2024") == "raw_trips_2024" and identifier("9a") == "_9a"
    with pytest.raises(ValueError, match="no letter or digit"):
        identifier("--")


def test_external_tables_show_all_batches_and_survive_replacement(spark, root):
    base = root + "t"
    spark.sql("select 1 as a").write.parquet(base + "/ingestion_timestamp=0123")
    spark.sql("select 2 as a, 'x' as b").write.parquet(base + "/ingestion_timestamp=0124")
    assert merged_schema(spark, base).fieldNames() == ["a", "b"]
    for _ in range(2):
        name = register_table(spark, "silver", "Some Table", base, True)
    rows = sorted(map(tuple, spark.table(name).collect()))
    assert name == "silver.some_table" and rows == [(1, None, "0123"), (2, "x", "0124")]
