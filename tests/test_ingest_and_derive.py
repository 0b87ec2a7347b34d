"""CSV ingest, validation and per-row derivation on hand-made rows."""

from __future__ import annotations

import datetime as dt
import gzip

import pytest
from fixtures import CASES, HEADER, plan_text, row, write_csv

from probelens.plans.pipeline import build_from_csv, clean_readings
from probelens.sources import csv_ingest as I


def _derived(spark, tmp_path):
    d = str(tmp_path / "raw")
    write_csv(d, "part1.csv", CASES)
    raw = I.load_probe_csv(spark, d)
    rows = clean_readings(raw.df).collect()
    return {(r["Timestamp"], r["Operatorname"]): r for r in rows}, raw


def test_threshold_edges_and_keys(spark, tmp_path):
    rows, _ = _derived(spark, tmp_path)
    r = rows[("2017.11.30_16.48.26", "A")]
    assert (r["Congestion"], r["Delay"], r["Journey_Pattern_ID"], r["Stop_ID"]) == (1, 50, "A_11", "11")
    assert (r["date"], r["hour"], r["year"], r["month"], r["day"]) == (dt.date(2017, 11, 30), 16, 2017, 11, 30)


def test_unparseable_cell_keeps_row_with_null_keys(spark, tmp_path):
    rows, _ = _derived(spark, tmp_path)
    r = rows[("2017.11.30_16.48.27", "A")]
    assert r["CellID"] is None
    assert (r["Congestion"], r["Delay"], r["Journey_Pattern_ID"], r["Stop_ID"]) == (0, 48, None, None)


def test_decimal_speed_row_is_dropped(spark, tmp_path):
    rows, _ = _derived(spark, tmp_path)
    assert ("2017.11.30_17.48.27", "A") not in rows


def test_bad_time_row_kept_with_null_time_parts(spark, tmp_path):
    rows, _ = _derived(spark, tmp_path)
    r = rows[("bad-time", "B")]
    assert r["timestamp_dt"] is None and r["date"] is None and r["hour"] is None and r["weekday"] is None
    assert r["Delay"] == 0 and r["Congestion"] == 0


def test_sunday_numbering(spark, tmp_path):
    rows, _ = _derived(spark, tmp_path)
    r = rows[("2017.12.03_23.59.59", "B")]
    assert r["Delay"] == 0 and r["weekday"] == 1  # dayofweek: Sunday=1
    from pyspark.sql import functions as F

    from probelens.functions.derive import iso_weekday

    iso = spark.range(1).select(iso_weekday(F.lit(dt.date(2017, 12, 3))).alias("w")).first()["w"]
    assert iso == 7


def test_null_operator_dropped(spark, tmp_path):
    rows, raw = _derived(spark, tmp_path)
    assert all(k[1] is not None for k in rows)
    assert len(rows) == 4  # 6 rows: decimal speed and null operator dropped


def test_quality_observation_counts_all_columns(spark, tmp_path):
    d = str(tmp_path / "raw")
    write_csv(d, "part1.csv", CASES)
    out = str(tmp_path / "out")
    report = build_from_csv(spark, d, out, check_all_columns=True)
    assert report["raw_rows"] == 6
    assert report["cleaned_rows"] == 4
    assert report["null_counts"]["Speed"] == 1
    assert report["null_counts"]["CellID"] == 1
    assert report["null_counts"]["Operatorname"] == 1
    assert set(report["null_counts"]) == {f for f in HEADER.split(",")}


def test_reordered_header_fails_whatever_columns_are_kept(spark, tmp_path):
    d = str(tmp_path / "raw")
    names = HEADER.split(",")
    # swap two columns that no aggregate uses
    i, j = names.index("RSRP"), names.index("RSRQ")
    names[i], names[j] = names[j], names[i]
    write_csv(d, "good.csv", CASES)
    write_csv(d, "bad.csv", CASES[:1], header=",".join(names))
    with pytest.raises(I.DataValidationError, match="bad.csv"):
        I.load_probe_csv(spark, d)


def test_headers_are_checked_before_any_data_is_scanned(spark, tmp_path, monkeypatch):
    d, out = str(tmp_path / "raw"), str(tmp_path / "out")
    for n in range(40):
        write_csv(d, f"good{n:02d}.csv", CASES * 50)
    write_csv(d, "empty.csv", [], header=None)
    write_csv(d, "cased.csv", CASES, header=HEADER.upper())
    write_csv(d, "marked.csv", CASES, header="\ufeff" + HEADER)
    with gzip.open(f"{d}/packed é.csv.gz", "wt") as fh:
        fh.write(HEADER + "\n" + CASES[0] + "\n")
    headers = list(I.file_headers(spark, d))
    assert len(headers) == 43
    assert {I._names(h)[0] for _, h in headers} == {"timestamp"}
    I.check_headers(spark, d)
    for name, header in (("short.csv", HEADER.rsplit(",", 1)[0]), ("long.csv", HEADER + ",more"), ("none.csv", CASES[0])):
        write_csv(f"{d}/{name}.d", name, CASES, header=header)
        monkeypatch.setattr(I, "read_raw_csv", lambda *a: pytest.fail("data was scanned"))
        with pytest.raises(I.DataValidationError, match=name):
            build_from_csv(spark, [d, f"{d}/{name}.d"], out)
        monkeypatch.undo()


def test_header_check_runs_no_job(spark, tmp_path):
    d = str(tmp_path / "raw")
    for n in range(3):
        write_csv(d, f"part{n}.csv", CASES * 1000)
    spark.sparkContext.setJobGroup("headers", "")
    try:
        I.check_headers(spark, d)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def _metric(plan, name):
    """The sum of a metric over the scans of an executed plan."""
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply(name).value() for i in range(leaves.size()))


def test_rejected_rows_by_file_and_reason(spark, tmp_path):
    d, out = str(tmp_path / "raw"), str(tmp_path / "out")
    write_csv(d, "a.csv", CASES)
    write_csv(d, "b.csv", [row("", "x", "", "1", lon="east"), CASES[0]])
    report = build_from_csv(spark, d, out, keep_rejected=True)
    rows = spark.read.parquet(report["rejected_path"]).collect()
    found = {(r["file"].rsplit("/", 1)[1], r["reason"], r["record"]) for r in rows}
    assert found == {
        ("a.csv", "Speed unreadable", CASES[2]),
        ("a.csv", "Operatorname missing", None),
        ("b.csv", "Timestamp missing, Longitude unreadable, Speed unreadable, Operatorname missing", row("", "x", "", "1", lon="east")),
    }
    assert report["rejected_rows"] == len(rows) == report["raw_rows"] - report["cleaned_rows"]


def test_empty_directory_fails(spark, tmp_path):
    d = tmp_path / "empty"
    d.mkdir()
    with pytest.raises(I.DataValidationError):
        I.load_probe_csv(spark, str(d))


def test_header_only_file_fails(spark, tmp_path):
    d = str(tmp_path / "raw")
    write_csv(d, "only_header.csv", [])
    with pytest.raises(I.DataValidationError):
        I.load_probe_csv(spark, d)


def test_missing_path_fails(spark, tmp_path):
    with pytest.raises(Exception):
        I.load_probe_csv(spark, str(tmp_path / "nope"))


def test_bad_header_is_a_validation_error_of_the_build(spark, tmp_path):
    d, out = str(tmp_path / "raw"), str(tmp_path / "out")
    names = HEADER.split(",")
    i, j = names.index("RSRP"), names.index("RSRQ")
    names[i], names[j] = names[j], names[i]
    write_csv(d, "good.csv", CASES)
    write_csv(d, "wrong.csv", CASES[:1], header=",".join(names))
    with pytest.raises(I.DataValidationError, match="header"):
        build_from_csv(spark, d, out)


def test_all_rows_dropped_raises(spark, tmp_path):
    d = str(tmp_path / "raw")
    write_csv(d, "part1.csv", [CASES[2]])  # only the decimal-speed row
    with pytest.raises(I.DataValidationError):
        build_from_csv(spark, d, str(tmp_path / "out"))


def test_required_only_observation_prunes_radio_columns(spark, tmp_path):
    d = str(tmp_path / "raw")
    write_csv(d, "part1.csv", CASES)
    full = I.load_probe_csv(spark, d, check_all_columns=True)
    lean = I.load_probe_csv(spark, d)
    from probelens.operators.aggregate import hourly_cell_base

    def read_schema(raw):
        plan = plan_text(hourly_cell_base(clean_readings(raw.df)))
        return [line for line in plan.splitlines() if "ReadSchema" in line][0]

    full_schema, lean_schema = read_schema(full), read_schema(lean)
    assert ",RSRP:int" in full_schema and ",RSRP:int" not in lean_schema
    assert "Speed:int" in lean_schema and "CellID:int" in lean_schema
