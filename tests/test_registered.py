"""Every registered query against its SQL twin, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from tierlake.plans.registered import ORACLES, QUERIES
from tools.check_oracle import TABLES, normal

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute("create view {0} as select * from read_parquet('{1}/{0}.parquet')".format(name, FOLDER))
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_rows_equal_sql(spark, database, name):
    found = QUERIES[name](spark, FOLDER).toPandas()
    expected = database.sql(ORACLES[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert normal(found).equals(normal(expected))


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
