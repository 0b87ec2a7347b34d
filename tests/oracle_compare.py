"""Compare a registered Spark query with its DuckDB statement.

Mirrors the driver's check: same row count, same column names, and the
same multiset of rows (columns sorted by name, order-insensitive).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def _canon(cols: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple("" if x is None else x for x in t))


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> dict:
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    res = {
        "name": name,
        "rows_spark": len(s_rows),
        "rows_oracle": len(d_rows),
        "cols_match": sorted(s_cols) == sorted(d_cols),
    }
    if res["cols_match"]:
        a, b = _canon(s_cols, s_rows), _canon(d_cols, d_rows)
        res["values_match"] = a == b
        if not res["values_match"]:
            diff_a = [x for x in a if x not in b][:3]
            diff_b = [x for x in b if x not in a][:3]
            res["example"] = {"spark_only": diff_a, "oracle_only": diff_b, "cols": sorted(s_cols)}
    else:
        res["values_match"] = False
        res["example"] = {"spark_cols": s_cols, "oracle_cols": d_cols}
    return res
