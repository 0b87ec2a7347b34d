"""The ``events`` adapter keeps wall-clock time whatever the session zone."""

from __future__ import annotations

from conftest import SF001
from pyspark.sql import functions as F

from probelens.operators import aggregate as A
from probelens.plans.pipeline import clean_readings
from probelens.sources.events import EVENTS_SCHEMA, events_path, readings_from_events

# A spring-forward day in the zone below: 02:00-02:59 does not exist there.
DST_ZONE = "America/New_York"
GAP_DAY = "2024-03-10"


def _events_in_gap(spark):
    """The given events, every reading moved to 02:MM:SS of the gap day."""
    ev = spark.read.schema(EVENTS_SCHEMA).parquet(events_path(SF001))
    moved = F.to_timestamp_ntz(F.concat(F.lit(f"{GAP_DAY} 02:"), F.date_format("ts", "mm:ss")))
    return ev.withColumn("ts", moved)


def test_gap_hour_is_kept_under_a_dst_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", DST_ZONE)
    try:
        readings = clean_readings(readings_from_events(_events_in_gap(spark)))
        hours = {r["hour"] for r in readings.select("hour").distinct().collect()}
        base = A.hourly_cell_base(readings)
        groups = {(r["date"].isoformat(), r["hour"]) for r in base.select("date", "hour").distinct().collect()}
        n = readings.count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert hours == {2}
    assert groups == {(GAP_DAY, 2)}
    assert n == spark.read.parquet(events_path(SF001)).count()


def test_timestamp_stays_without_zone(spark):
    readings = readings_from_events(spark.read.schema(EVENTS_SCHEMA).parquet(events_path(SF001)))
    assert dict(readings.dtypes)["timestamp_dt"] == "timestamp_ntz"
