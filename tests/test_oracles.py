"""Every query with an SQL twin must agree with it on the small test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from peerledger.catalog import QUERIES
from helpers import table

SF = "/root/testdata/sf0.001"
NAMES = sorted(n for n in entry_points.oracle_sql() if n in QUERIES)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF):
        name = file.removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{SF}/{file}'")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_twin(spark, duck, name):
    got = entry_points.queries()[name](spark, SF)
    expected = duck.sql(entry_points.oracle_sql()[name])
    assert sorted(got.columns) == sorted(expected.columns)
    assert table(got.columns, [tuple(r) for r in got.collect()]) == table(expected.columns, expected.fetchall())


def test_entry_has_rows_and_label_last(spark):
    df = entry_points.entry(spark)
    assert df.columns[-1] == "fraud_label"
    assert df.count() > 0
    assert {r[0] for r in df.select("fraud_label").distinct().collect()} == {0, 1}


def test_every_query_is_callable():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
