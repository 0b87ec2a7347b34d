"""The published summary, resumed builds and skipping by route."""

from __future__ import annotations

import glob
import os

import pytest
from conftest import SF001, SF01
from pyspark.sql import functions as F
from test_ingest_and_derive import _metric

from probelens import config as C
from probelens.operators import aggregate as A
from probelens.operators import summary as S
from probelens.plans import pipeline as P
from probelens.sources import tables as TB
from probelens.sources.paths import read_text, write_text


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("store"))
    P.build_from_events(spark, SF01, out)
    return out


class Killed(BaseException):
    """Not an error that any code here handles."""


def _rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("point", ["rejects", "publish", "replace_file"])
def test_a_load_that_dies_between_its_writes_changes_nothing(spark, built, tmp_path, monkeypatch, point):
    root = str(tmp_path / "s")
    first = P.load_summary(spark, built, root, "t0")
    before = _rows(S.read_summary(spark, root))

    def die(*args):
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(S, point, die)
        with pytest.raises(Killed):
            P.load_summary(spark, built, root, "t1")
    loads = [d for d in os.listdir(f"{root}/data") if d.startswith("load=")]
    assert len(loads) == 2  # the second load had written its rows
    assert S.current_version(spark, root) == first["version"]
    assert _rows(S.read_summary(spark, root)) == before
    again = P.load_summary(spark, built, root, "t2")
    assert {r["updated_at"] for r in S.read_summary(spark, root).collect()} == {"t2"}
    assert {k: again[k] for k in S.COUNTS} == {k: first[k] for k in S.COUNTS}
    assert _rows(S.read_summary(spark, root, first["version"])) == before


def test_a_first_load_that_dies_leaves_no_summary(spark, built, tmp_path, monkeypatch):
    root = str(tmp_path / "s")
    with monkeypatch.context() as patch:
        patch.setattr(S, "publish", lambda *a: (_ for _ in ()).throw(Killed))
        with pytest.raises(Killed):
            P.load_summary(spark, built, root, "t0")
    with pytest.raises(FileNotFoundError):
        S.read_summary(spark, root)


def test_a_load_does_not_undo_another(spark, built, tmp_path, monkeypatch):
    root = str(tmp_path / "s")
    P.load_summary(spark, built, root, "t0")
    publish = S.publish

    def late(*args):
        with monkeypatch.context() as patch:
            patch.setattr(S, "publish", publish)
            late.other = P.load_summary(spark, built, root, "other")
        publish(*args)

    with monkeypatch.context() as patch:
        patch.setattr(S, "publish", late)
        with pytest.raises(RuntimeError, match="another load"):
            P.load_summary(spark, built, root, "t1")
    assert S.current_version(spark, root) == late.other["version"]
    assert {r["updated_at"] for r in S.read_summary(spark, root).collect()} == {"other"}


def test_rejects_and_counts_come_from_the_files(spark, built, tmp_path):
    root = str(tmp_path / "s")
    report = P.load_summary(spark, built, root, "t0")
    rejects = S.read_rejects(spark, root)
    assert rejects.count() == report["failed"] > 0
    assert {r["reason"] for r in rejects.collect()} == {"route_id missing"}
    assert S.read_summary(spark, root).count() == report["success"]
    assert {r["grain"]: r["total"] for r in S.committed_report(spark, root).collect()} == {g: report[g]["total"] for g in S.GRAINS}
    assert S.manifest(spark, root, report["version"])["report"] == {**{k: report[k] for k in S.COUNTS}, **{g: report[g] for g in S.GRAINS}}


def test_loads_of_nothing_and_of_unstorable_rows(spark, built, tmp_path):
    root = str(tmp_path / "s")
    daily = S.daily_items(TB.read_route_daily(spark, built), "t0")
    none = S.write_upsert(spark, root, {"daily": daily.where("false")})
    assert (none["success"], none["failed"]) == (0, 0) and S.read_summary(spark, root).count() == 0
    bad = daily.withColumn("operator", F.lit(None).cast("string")).withColumn("time_bucket", F.lit(None).cast("string"))
    report = S.write_upsert(spark, root, {"daily": bad})
    assert report["success"] == 0 and report["failed"] == daily.count() and S.read_summary(spark, root).count() == 0
    assert "time_bucket missing,operator missing" in {r["reason"] for r in S.read_rejects(spark, root).collect()}
    assert S.write_upsert(spark, root, {"daily": daily})["success"] == S.read_summary(spark, root).count() > 0


def test_stored_rows_of_other_dates_are_not_read(spark, built, tmp_path):
    from fixtures import plan_text

    root = str(tmp_path / "s")
    P.load_summary(spark, built, root, "t0")
    held = S.manifest(spark, root, S.current_version(spark, root))["dates"]
    one = min(held)
    plan = plan_text(S._stored(spark, root, {one: held[one]}))
    assert f"bucket_date={one}" in plan and sum(f"bucket_date={d}" in plan for d in held) == 1


# ---------------------------------------------------------------- resume
def test_a_failed_build_resumes_from_its_base(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "c")
    write = TB.write_curated

    def fail_daily(df, root, name, laid_out=False):
        path = write(df, root, name, laid_out)
        if name == C.ROUTE_DAILY:
            raise OSError("no space left")
        return path

    with monkeypatch.context() as patch:
        patch.setattr(TB, "write_curated", fail_daily)
        with pytest.raises(OSError, match="no space"):
            P.refresh(spark, out, sf_dir=SF001)
    assert not os.path.exists(TB.table_path(out, C.ROUTE_DAILY))
    made = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{out}/{C.HOURLY_BASE}/*")}
    with monkeypatch.context() as patch:
        patch.setattr(A, "hourly_cell_base", lambda *a: pytest.fail("the raw input was read again"))
        report = P.refresh(spark, out, sf_dir=SF001)["etl"]
        again = P.refresh(spark, out, sf_dir=SF001)["etl"]
    assert C.HOURLY_BASE in report["resumed"] and C.ROUTE_DAILY not in report["resumed"]
    assert set(again["resumed"]) == {C.HOURLY_BASE, *P.TABLES}
    assert made == {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{out}/{C.HOURLY_BASE}/*")}
    fresh = P.build_from_events(spark, SF001, str(tmp_path / "fresh"))
    for name in P.TABLES:
        x, y = TB.read_curated(spark, out, name), TB.read_curated(spark, str(tmp_path / "fresh"), name)
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0
    assert {k: fresh[k] for k in ("raw_rows", "cleaned_rows", "hourly_groups")} == {k: again[k] for k in ("raw_rows", "cleaned_rows", "hourly_groups")}


def test_a_root_of_another_input_is_refused(spark, tmp_path):
    from fixtures import CASES, write_csv

    out, raw = str(tmp_path / "c"), str(tmp_path / "raw")
    write_csv(raw, "a.csv", CASES)
    P.build_from_csv(spark, raw, out)
    assert P.build_from_csv(spark, raw, out)["resumed"]
    write_csv(raw, "b.csv", CASES[:1])  # the input has grown
    for build in (lambda: P.build_from_csv(spark, raw, out), lambda: P.build_from_events(spark, SF001, out), lambda: P.build_curated(spark, spark.read.parquet(f"{SF001}/events.parquet"), out)):
        with pytest.raises(FileExistsError):
            build()
    os.makedirs(f"{tmp_path}/d/{C.ROUTE_DAILY}")  # a table that no build has finished
    with pytest.raises(FileExistsError):
        P.build_from_events(spark, SF001, f"{tmp_path}/d")


def test_small_files_are_written_once(spark, tmp_path):
    path = f"{tmp_path}/x/CURRENT"
    assert read_text(spark, path) is None
    write_text(spark, path, "größe")
    assert read_text(spark, path) == "größe"
    with pytest.raises(Exception, match="(?i)exist"):
        write_text(spark, path, "again")


# ------------------------------------------------------------ route filters
@pytest.mark.parametrize(("name", "key"), [(C.ROUTE_HOURLY, "Journey_Pattern_ID"), (C.ROUTE_DAILY, "Journey_Pattern_ID"), (C.STOP_HOURLY, "Stop_ID")])
def test_a_route_predicate_skips_rows(spark, tmp_path, name, key):
    """Small pages and row groups stand in for the size of real files."""
    small = {"parquet.block.size": "4096", "parquet.page.size": "512", "parquet.page.row.count.limit": "20", "parquet.page.size.row.check.min": "10", "parquet.block.size.row.check.min": "20"}
    full = TB.table_path(str(tmp_path), name)
    out = str(tmp_path / "whole")
    P.build_from_events(spark, SF01, out)
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        # one date, so that a file holds many routes
        one = TB.read_curated(spark, out, name).withColumn("aggregation_date", F.lit("2024-01-05").cast("date"))
        TB.write_curated(TB.conform(one, name), str(tmp_path), name)
    finally:
        for k in small:
            spark.conf.unset(k)
    table = TB.read_curated(spark, str(tmp_path), name)
    keys = sorted(r[0] for r in table.select(key).distinct().collect() if r[0])

    def scanned(value):
        df = table.where(F.col(key) == value)
        n = len(df.collect())
        return _metric(df._jdf.queryExecution().executedPlan(), "numOutputRows"), n

    total = table.count()
    read, n = scanned(keys[len(keys) // 2])
    assert 0 < n <= read < total / 2, full
    assert scanned(keys[3] + "_")[0] == 0  # between the bounds, held by no file
