"""Batch build and summary load: invariants over the written tables."""

from __future__ import annotations

import pytest
from conftest import SF01
from pyspark.sql import functions as F

from probelens import config as C
from probelens.operators import summary as S
from probelens.plans import catalog
from probelens.plans.pipeline import build_from_events, load_summary, refresh
from probelens.sources import tables as TB


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("curated"))
    report = build_from_events(spark, SF01, out)
    return out, report


def test_counts_agree_across_tables(spark, built):
    out, report = built
    events = spark.read.parquet(f"{SF01}/events.parquet").count()
    hourly = TB.read_route_hourly(spark, out).agg(F.sum("trip_count")).first()[0]
    daily = TB.read_route_daily(spark, out).agg(F.sum("trip_count")).first()[0]
    stops = TB.read_stop_hourly(spark, out).agg(F.sum("total_count")).first()[0]
    assert report["raw_rows"] == events
    assert hourly == daily == stops == report["cleaned_rows"] == events


def test_rates_and_delays_bounded(spark, built):
    out, _ = built
    for name in (C.ROUTE_HOURLY, C.ROUTE_DAILY):
        df = TB.read_curated(spark, out, name)
        bad = df.where(
            (F.col("congestion_rate") < 0)
            | (F.col("congestion_rate") > 100)
            | (F.col("min_delay") > F.col("avg_delay"))
            | (F.col("avg_delay") > F.col("max_delay"))
        ).count()
        assert bad == 0
    stops = TB.read_stop_hourly(spark, out)
    assert stops.where((F.col("congestion_rate") < 0) | (F.col("congestion_rate") > 100)).count() == 0


def test_null_route_groups_kept(spark, built):
    out, _ = built
    hourly = TB.read_route_hourly(spark, out)
    assert hourly.where(F.col("Journey_Pattern_ID").isNull()).count() > 0
    stops = TB.read_stop_hourly(spark, out)
    assert stops.where(F.col("Stop_ID").isNull()).count() > 0


def test_written_tables_equal_lazy_operators(spark, built):
    out, _ = built
    pairs = {
        C.ROUTE_HOURLY: catalog.q_route_delay_by_hour,
        C.ROUTE_DAILY: catalog.q_route_delay_daily,
        C.STOP_HOURLY: catalog.q_stop_congestion_hourly,
    }
    for name, q in pairs.items():
        written = catalog.settle(TB.read_curated(spark, out, name))
        lazy = q(spark, SF01).select(*written.columns)
        assert written.exceptAll(lazy).count() == 0
        assert lazy.exceptAll(written).count() == 0


def test_curated_tables_partitioned_by_date(spark, built):
    out, _ = built
    import os

    dirs = os.listdir(TB.table_path(out, C.ROUTE_HOURLY))
    assert any(d.startswith("aggregation_date=2024-01-") for d in dirs)


def test_date_filter_prunes_partitions(spark, built):
    out, _ = built
    from fixtures import plan_text

    df = TB.read_route_hourly(spark, out).where(F.col("aggregation_date") == F.lit("2024-01-05").cast("date"))
    plan = plan_text(df)
    assert "PartitionFilters: [isnotnull(aggregation_date" in plan
    assert df.select("aggregation_date").distinct().count() == 1


def test_summary_load_and_upsert_idempotent(spark, built, tmp_path):
    out, _ = built
    root = str(tmp_path / "summary")
    r1 = load_summary(spark, out, root, updated_at="2024-02-01T00:00:00")
    items = S.summary_items(TB.read_route_daily(spark, out), TB.read_route_hourly(spark, out), "x")
    expected = S.load_report(items).first().asDict()
    assert {k: r1[k] for k in ("success", "failed", "total")} == expected
    assert r1["failed"] > 0  # null-route rows are set aside (D8)
    r2 = load_summary(spark, out, root, updated_at="2024-02-01T00:00:00")
    assert r2["success"] == r1["success"] and r2["version"] > r1["version"]
    a, b = S.read_summary(spark, root, r1["version"]), S.read_summary(spark, root)
    assert a.count() == b.count() == r1["success"]
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    keys = a.groupBy("route_id", "time_bucket").count().where("count > 1").count()
    assert keys == 0


def test_summary_lies_apart_from_its_inputs(spark, built, tmp_path):
    out, _ = built
    daily = TB.read_route_daily(spark, out).count()
    for root in (out, f"{out}/{C.ROUTE_DAILY}", f"file:{out}//{C.ROUTE_HOURLY}/new", f"file://{out}/x/.."):
        with pytest.raises(ValueError, match="overlap"):
            load_summary(spark, out, root, updated_at="t1")
    assert TB.read_route_daily(spark, out).count() == daily


def test_load_report_per_grain(spark, built, tmp_path):
    out, _ = built
    report = load_summary(spark, out, str(tmp_path / "v"), updated_at="t0")
    for grain, table in (("daily", TB.read_route_daily(spark, out)), ("hourly", TB.read_route_hourly(spark, out))):
        assert report[grain]["total"] == table.count()
        assert report[grain]["failed"] == table.where("Journey_Pattern_ID IS NULL OR Operatorname IS NULL OR aggregation_date IS NULL").count()
    assert all(report[k] == report["daily"][k] + report["hourly"][k] for k in ("success", "failed", "total"))


def test_only_touched_dates_are_merged(spark, built, tmp_path):
    import os

    out, _ = built
    root = str(tmp_path / "v")
    first = load_summary(spark, out, root, updated_at="t0")
    old = S.read_summary(spark, root)
    day = S.daily_items(TB.read_route_daily(spark, out).where("aggregation_date = DATE'2024-01-09'"), "t1")
    second = S.write_upsert(spark, root, {"daily": day})
    new = S.read_summary(spark, root)
    assert new.count() == old.count()
    changed = new.where("updated_at = 't1'").select("time_bucket").distinct().collect()
    assert [r[0] for r in changed] == ["2024-01-09"]
    written = os.listdir(f"{root}/data/load={second['version']}")
    assert [d for d in written if "=" in d] == ["bucket_date=2024-01-09"]
    dates = S.manifest(spark, root, second["version"])["dates"]
    assert set(dates.values()) == {first["version"], second["version"]} and dates["2024-01-09"] == second["version"]


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_report_is_true_and_a_failed_build_harms_nothing(spark, tmp_path, adaptive):
    from fixtures import CASES, HEADER, write_csv

    from probelens.plans.pipeline import build_from_csv
    from probelens.sources.csv_ingest import DataValidationError

    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        out = str(tmp_path / "v1")
        report = build_from_events(spark, SF01, out)
        base = TB.read_base(spark, out)
        events = spark.read.parquet(f"{SF01}/events.parquet")
        assert report["raw_rows"] == events.count()
        assert report["cleaned_rows"] == base.agg(F.sum("n")).first()[0] == events.where("value IS NOT NULL AND ts IS NOT NULL").count()
        assert report["hourly_groups"] == base.count()
        dropped, wrong = str(tmp_path / "dropped"), str(tmp_path / "wrong")
        write_csv(dropped, "a.csv", [CASES[2]])
        names = HEADER.split(",")
        write_csv(wrong, "a.csv", CASES, header=",".join([names[1], names[0], *names[2:]]))
        for n, bad in enumerate((dropped, wrong)):
            with pytest.raises(FileExistsError):
                build_from_csv(spark, bad, out)
            with pytest.raises(DataValidationError):
                build_from_csv(spark, bad, str(tmp_path / f"bad{n}"))
        assert TB.read_base(spark, out).count() == report["hourly_groups"]
        assert TB.read_route_hourly(spark, out).count() == report["hourly_groups"]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_writes_run_in_the_callers_job_group(spark, tmp_path):
    sc = spark.sparkContext
    sc.setJobGroup("build-group", "a build")
    try:
        build_from_events(spark, "/root/testdata/sf0.001", str(tmp_path / "g"))
        inside = len(sc.statusTracker().getJobIdsForGroup("build-group"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    outside = sc.statusTracker().getJobIdsForGroup(None)
    assert inside >= 5  # the base, its count and the three tables
    sc.setJobGroup("other", "")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert not set(outside) & set(sc.statusTracker().getJobIdsForGroup("build-group"))


def test_unknown_quality_is_reported_as_unknown():
    from py4j.protocol import Py4JError

    from probelens.plans.pipeline import _observed

    class Unseen:
        @property
        def get(self):
            raise Py4JError("nothing was observed")

    assert _observed(Unseen()) is None


def test_upsert_replaces_and_keeps(spark):
    cols = [f.name for f in C.SUMMARY_SCHEMA.fields]
    old = spark.createDataFrame(
        [("A_1", "2024-01-01", "A", 1.0, 1, 1, 1, 0, 0.0, "t0"), ("A_1", "2024-01-02", "A", 2.0, 2, 2, 1, 0, 0.0, "t0")],
        C.SUMMARY_SCHEMA,
    )
    new = spark.createDataFrame(
        [("A_1", "2024-01-02", "A", 9.0, 9, 9, 3, 1, 33.3, "t1"), (None, "2024-01-03", "A", 1.0, 1, 1, 1, 0, 0.0, "t1")],
        C.SUMMARY_SCHEMA,
    )
    got = {(r["route_id"], r["time_bucket"]): r["updated_at"] for r in S.upsert(old, new).select(*cols).collect()}
    assert got == {("A_1", "2024-01-01"): "t0", ("A_1", "2024-01-02"): "t1"}


def test_refresh_report(spark, tmp_path):
    out = str(tmp_path / "cur")
    rep = refresh(spark, out, sf_dir="/root/testdata/sf0.001", summary_root=str(tmp_path / "sum"))
    assert rep["success"] and rep["etl"]["cleaned_rows"] > 0
    assert rep["summary"]["total"] == rep["summary"]["success"] + rep["summary"]["failed"]
    with pytest.raises(ValueError):
        refresh(spark, out)


def test_csv_text_path_equals_typed_path(spark, tmp_path):
    """Raw CSV (several part files, text times) builds the same tables as
    the typed ``events`` path."""
    from pyspark.sql import functions as F

    from probelens.plans.pipeline import build_from_csv
    from probelens.sources.events import raw_text_timestamp, read_event_readings

    sf = "/root/testdata/sf0.001"
    raw = raw_text_timestamp(read_event_readings(spark, sf))
    cols = [(F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in C.RAW_SCHEMA.fields]
    csv_dir = str(tmp_path / "csv")
    raw.select(*cols).repartition(3).write.option("header", True).csv(csv_dir)

    a, b = str(tmp_path / "from_csv"), str(tmp_path / "from_events")
    ra = build_from_csv(spark, csv_dir, a)
    rb = build_from_events(spark, sf, b)
    assert ra["cleaned_rows"] == rb["cleaned_rows"] == ra["raw_rows"]
    for name in (C.ROUTE_HOURLY, C.ROUTE_DAILY, C.STOP_HOURLY):
        x, y = TB.read_curated(spark, a, name), TB.read_curated(spark, b, name)
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_cli_success_and_failure(spark, tmp_path, capsys):
    import json

    from probelens.plans.pipeline import main

    out = str(tmp_path / "cli")
    code = main(["--events-dir", "/root/testdata/sf0.001", "--out", out, "--summary-root", str(tmp_path / "sv1")])
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert code == 0 and report["success"] and report["summary"]["success"] > 0
    code = main(["--raw", str(tmp_path / "missing"), "--out", str(tmp_path / "cli2")])
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert code == 1 and report["success"] is False


def test_hourly_tables_are_map_only_with_one_file_per_date(spark, built):
    import os
    import re

    from fixtures import plan_text

    from probelens.operators import aggregate as A

    out, report = built
    base = TB.read_base(spark, out)
    dates = base.select("date").distinct().count()
    base_files = [f for f in os.listdir(TB.table_path(out, C.HOURLY_BASE)) if f.endswith(".parquet")]
    assert 1 <= len(base_files) <= dates  # rebalanced on the date
    for name in (C.ROUTE_HOURLY, C.STOP_HOURLY):
        table = TB.table_path(out, name)
        per_date = [len([f for f in os.listdir(os.path.join(table, d)) if f.endswith(".parquet")]) for d in os.listdir(table) if "=" in d]
        assert len(per_date) == dates and set(per_date) == {1}
    assert base.count() == report["hourly_groups"]
    for name, build in ((C.ROUTE_HOURLY, A.route_delay_by_hour), (C.STOP_HOURLY, A.stop_congestion_hourly)):
        tree = plan_text(TB.conform(build(base), name).sortWithinPartitions("aggregation_date")).split("\n\n")[0]
        assert "Exchange" not in tree
    daily = plan_text(TB.conform(A.route_delay_daily(base), C.ROUTE_DAILY)).split("\n\n")[0]
    assert len(re.findall(r"Exchange", daily)) == 1  # the roll-up aggregates


def test_null_date_group_survives_the_base(spark, tmp_path):
    from fixtures import CASES, write_csv

    from probelens.plans.pipeline import build_from_csv

    d = str(tmp_path / "raw")
    write_csv(d, "part1.csv", CASES)
    out = str(tmp_path / "out")
    build_from_csv(spark, d, out)
    rows = TB.read_route_hourly(spark, out).where(F.col("aggregation_date").isNull()).collect()
    assert [(r["Journey_Pattern_ID"], r["hour"], r["trip_count"]) for r in rows] == [("B_12", None, 1)]
    total = TB.read_stop_hourly(spark, out).agg(F.sum("total_count")).first()[0]
    assert total == 4


def test_build_with_adaptive_execution_off_gives_the_same_tables(spark, built, tmp_path):
    import os

    out, _ = built
    other = str(tmp_path / "no_aqe")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        build_from_events(spark, SF01, other)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    for name in (C.ROUTE_HOURLY, C.ROUTE_DAILY, C.STOP_HOURLY):
        x, y = TB.read_curated(spark, out, name), TB.read_curated(spark, other, name)
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, name
        table = TB.table_path(other, name)
        dates = [d for d in os.listdir(table) if "=" in d]
        files = sum(len([f for f in os.listdir(os.path.join(table, d)) if f.endswith(".parquet")]) for d in dates)
        assert files <= 2 * len(dates), name  # not one file per task and date
