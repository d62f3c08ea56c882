"""Queries with an SQL twin must agree with it on the small test tables."""

import os

import duckdb
import pytest

from helpers import table
from peerledger.llm import queries  # noqa: F401
from peerledger.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, name):
    connection = duckdb.connect()
    for file in os.listdir(SF):
        connection.execute(f"create view {file.removesuffix('.parquet')} as select * from '{SF}/{file}'")
    got = QUERIES[name](spark, SF)
    expected = connection.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(expected.columns)
    assert table(got.columns, [tuple(r) for r in got.collect()]) == table(expected.columns, expected.fetchall())
