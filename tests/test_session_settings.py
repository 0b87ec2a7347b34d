"""Results do not depend on the session time zone or on ANSI mode.

Event times are wall-clock (TIMESTAMP_NTZ) and time text is parsed with
``try_`` functions, so every registered query must give the oracle's rows
under a daylight-saving session zone and with ANSI mode off (the default of
older Spark releases) as well as under the test session's defaults.
"""

from __future__ import annotations

import pytest
from conftest import SF001
from oracle_compare import compare, duck

from probelens.plans import catalog
from probelens.plans.oracle import ORACLE_SQL

SETTINGS = [
    ("spark.sql.session.timeZone", "America/New_York"),
    ("spark.sql.ansi.enabled", "false"),
]


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("key,value", SETTINGS, ids=[v for _, v in SETTINGS])
def test_every_query_matches_oracle_under_setting(spark, con, key, value):
    old = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        bad = []
        for name, q in catalog.QUERIES.items():
            r = compare(spark, con, name, q, ORACLE_SQL[name], SF001)
            if not (r["cols_match"] and r["rows_spark"] == r["rows_oracle"] and r["values_match"]):
                bad.append(name)
    finally:
        spark.conf.set(key, old)
    assert bad == []
