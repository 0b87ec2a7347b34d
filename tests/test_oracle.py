"""Every registered query against its DuckDB statement (the driver's check)."""

from __future__ import annotations

import pytest
from conftest import SF01
from oracle_compare import compare, duck

import __spark_entry__ as entry
from probelens.plans import catalog
from probelens.plans.oracle import ORACLE_SQL

QUERIES = catalog.QUERIES
SQL = ORACLE_SQL


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, QUERIES[name], SQL[name], SF01)
    assert res["cols_match"], res
    assert res["rows_spark"] == res["rows_oracle"], res
    assert res["values_match"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "congestion_rate" in df.columns
