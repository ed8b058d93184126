from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tierlake.functions.scalars import blank_to_null, fill_null, hash_key, typed_cast

NUMBERS = [
    ("12", 12, 12.0),
    ("12.7", 12, 12.7),
    (" 12 ", 12, 12.0),
    ("8.0", 8, 8.0),
    ("-3.9", -3, -3.9),
    (".5", 0, 0.5),
    ("5.", 5, 5.0),
    ("1e3", None, 1000.0),
    ("1.2.3", None, None),
    ("abc", None, None),
    ("abc.5", None, None),
    ("99999999999", None, 99999999999.0),
    ("+5", 5, 5.0),
    ("12d", None, 12.0),
    (None, None, None),
]


def test_numbers_cast_without_raising(spark):
    frame = spark.createDataFrame([(text,) for text, _, _ in NUMBERS], "v string")
    rows = frame.select(typed_cast(F.col("v"), "integer"), typed_cast(F.col("v"), "double")).collect()
    assert [tuple(row) for row in rows] == [(whole, real) for _, whole, real in NUMBERS]


def test_nan_text_is_a_number(spark):
    row = spark.sql("select 'NaN' as v").select(F.isnan(typed_cast(F.col("v"), "double"))).first()
    assert row[0] is True


def test_times_and_other_types(spark):
    frame = spark.sql("select explode(array('2023-01-01T00:15:00.000', '2023-13-01', '2023')) as v")
    rows = frame.select(typed_cast(F.col("v"), "timestamp").cast("string"), typed_cast(F.col("v"), "date").cast("string"))
    assert [tuple(row) for row in rows.collect()] == [
        ("2023-01-01 00:15:00", "2023-01-01"),
        (None, None),
        ("2023-01-01 00:00:00", "2023-01-01"),
    ]
    assert spark.sql("select '3.456' as v").select(typed_cast(F.col("v"), "decimal(10,2)").cast("string")).first()[0] == "3.46"


def test_blank_is_spaces_only(spark):
    frame = spark.createDataFrame([("",), ("   ",), ("\t",), (" a ",), (None,)], "v string")
    rows = [row[0] for row in frame.select(blank_to_null(F.col("v"))).collect()]
    assert rows == [None, None, "\t", " a ", None]


def test_fill_keeps_the_declared_type(spark):
    filled = spark.sql("select cast(null as int) as v").select(fill_null(F.col("v"), 0.0, "integer").alias("v"))
    assert filled.dtypes == [("v", "int")] and filled.first()[0] == 0


def test_hash_skips_nulls_unless_told_otherwise(spark):
    frame = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    loose = [row[0] for row in frame.select(hash_key(["x", "y", "z"])).collect()]
    strict = [row[0] for row in frame.select(hash_key(["x", "y", "z"], null_token="?")).collect()]
    assert loose == [hashlib.sha256(b"a||b").hexdigest()] * 2
    assert strict == [hashlib.sha256(b"a||?||b").hexdigest(), hashlib.sha256(b"a||b||?").hexdigest()]


@pytest.mark.parametrize("type_name", ["integer", "bigint", "smallint", "tinyint"])
def test_every_whole_number_type_drops_fractions(spark, type_name):
    assert spark.sql("select '7.9' as v").select(typed_cast(F.col("v"), type_name)).first()[0] == 7
