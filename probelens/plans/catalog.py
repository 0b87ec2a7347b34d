"""Registered queries: each operator of the inventory as a plan over the
driver's tables (``queries()`` in ``__spark_entry__``).

Every query reads the whole ``events`` table of a scale-factor directory,
maps it to raw readings and runs the same code path as the batch build
(clean -> derive -> hourly cell base -> curated table) and then the report,
as one lazy plan. Filter selections below are fixed parameters of each
query; they are chosen to exercise every predicate of the filter bar.

Double columns are rounded to 6 decimals at the very end (``settle``), so
that means of means computed in a different summation order by the SQL
oracle compare equal; operators themselves never round.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probelens import config as C
from probelens.operators import aggregate as A
from probelens.operators import reports as R
from probelens.operators import summary as S
from probelens.operators.filters import FilterSpec
from probelens.plans.pipeline import build_from_csv, build_from_events, clean_readings, load_summary, refresh
from probelens.sources import csv_ingest as I
from probelens.sources import tables as TB
from probelens.sources.events import EVENTS_SCHEMA, events_path, raw_text_timestamp, read_event_readings, readings_from_events
from probelens.sources.paths import make_folder, qualified, shared_dir

# Fixed parameters of the registered queries.
OVERVIEW_SPEC = FilterSpec(
    date_range=(dt.date(2024, 1, 3), dt.date(2024, 1, 27)),
    weekdays=(1, 2, 3, 4, 5),
    hour_bands=((6, 10), (16, 20)),
)
ROUTE_SPEC = FilterSpec(
    date_range=(dt.date(2024, 1, 1), dt.date(2024, 1, 31)),
    hour_bands=((0, 23),),
    operator="A",
)
ROUTE_SELECTED_SPEC = FilterSpec(
    date_range=(dt.date(2024, 1, 5), dt.date(2024, 1, 25)),
    weekdays=(6, 7),
    routes=("A_1", "A_2", "A_3", "B_4", "B_7"),
    hour_bands=((0, 23),),
)
STOP_SPEC = FilterSpec(
    date_range=(dt.date(2024, 1, 1), dt.date(2024, 1, 31)),
    hour_bands=((7, 22),),
    operator="B",
)
AB_SPEC = FilterSpec(date_range=(dt.date(2024, 1, 1), dt.date(2024, 1, 31)))
STOP_TOP_N = 10
UPSERT_OLD_STAMP = "2024-02-01T00:00:00"
UPSERT_NEW_STAMP = "2024-02-02T00:00:00"
UPSERT_PARTIAL_FROM = "2024-01-20 00:00:00"  # whole days: a daily row is replaced by a full day's figure
NO_HOUR_BAND = "24-24"  # a band that no reading hour falls into
# Shares of the events that text_time_readings and csv_rejected_rows spoil, by event_id modulus.
BAD_TIME, NO_SPEED, NO_OPERATOR, NO_LONGITUDE = 7, 11, 13, 17


def settle(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column to ``digits`` decimals (comparison only)."""
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_readings(read_event_readings(spark, sf_dir))


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.hourly_cell_base(readings(spark, sf_dir))


def route_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.route_delay_by_hour(base(spark, sf_dir))


def route_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.route_delay_daily(base(spark, sf_dir))


def stop_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.stop_congestion_hourly(base(spark, sf_dir))


def q_derived_readings(spark, sf_dir):
    """VAL-3, PRJ-2 ... PRJ-9 on typed times: cleaned readings with every derived column."""
    df = readings(spark, sf_dir)
    return df.select(
        F.date_format("timestamp_dt", "yyyy-MM-dd HH:mm:ss").alias("timestamp_dt"),
        "date",
        "year",
        "month",
        "day",
        "hour",
        "weekday",
        "Speed",
        "Operatorname",
        "CellID",
        "Congestion",
        "Delay",
        "Journey_Pattern_ID",
        "Stop_ID",
    )


def q_route_delay_daily(spark, sf_dir):
    """AGG-1, PRJ-10."""
    return settle(route_daily(spark, sf_dir))


def q_route_delay_by_hour(spark, sf_dir):
    """AGG-2 (with avg_speed, D6)."""
    return settle(route_hourly(spark, sf_dir))


def q_stop_congestion_hourly(spark, sf_dir):
    """AGG-3."""
    return settle(stop_hourly(spark, sf_dir))


def q_overview_kpis(spark, sf_dir):
    """AGG-4, PRJ-11, FLT-1/2/4/7."""
    return settle(R.overview_kpis(route_hourly(spark, sf_dir), OVERVIEW_SPEC))


def q_overview_by_date(spark, sf_dir):
    """AGG-5, SRT-1."""
    return settle(R.overview_by_date(route_hourly(spark, sf_dir), OVERVIEW_SPEC))


def q_overview_by_hour(spark, sf_dir):
    """AGG-6, SRT-2."""
    return settle(R.overview_by_hour(route_hourly(spark, sf_dir), OVERVIEW_SPEC))


def q_overview_by_date_table(spark, sf_dir):
    """PRJ-16 (overview detail table)."""
    return R.overview_date_table(R.overview_by_date(route_hourly(spark, sf_dir), OVERVIEW_SPEC))


def q_route_choices(spark, sf_dir):
    """D7: routes offered by the filter bar."""
    return R.route_choices(route_hourly(spark, sf_dir))


def q_operator_choices(spark, sf_dir):
    """D7: operators offered by the filter bar."""
    return R.operator_choices(route_hourly(spark, sf_dir))


def q_route_kpis(spark, sf_dir):
    """AGG-7 with a route list and weekend days (FLT-2, FLT-3)."""
    return settle(R.route_kpis(route_hourly(spark, sf_dir), ROUTE_SELECTED_SPEC))


def q_route_delay_by_date(spark, sf_dir):
    """AGG-8, SRT-1, FLT-5."""
    return settle(R.route_delay_by_date(route_hourly(spark, sf_dir), ROUTE_SPEC))


def q_route_delay_by_hour_of_day(spark, sf_dir):
    """AGG-9, SRT-2."""
    return settle(R.route_delay_by_hour_of_day(route_hourly(spark, sf_dir), ROUTE_SPEC))


def q_route_top10_delay(spark, sf_dir):
    """AGG-10, TOP-1 (over both operators)."""
    spec = FilterSpec(date_range=ROUTE_SPEC.date_range, hour_bands=ROUTE_SPEC.hour_bands)
    return settle(R.top_routes_by_delay(route_hourly(spark, sf_dir), spec))


def q_route_detail_first100(spark, sf_dir):
    """LIM-1."""
    return settle(R.route_detail(route_hourly(spark, sf_dir), ROUTE_SPEC))


def _top_stops(spark, sf_dir):
    return R.top_stops(stop_hourly(spark, sf_dir), STOP_SPEC, STOP_TOP_N)


def q_stop_top_n(spark, sf_dir):
    """AGG-11, TOP-2, PRJ-11."""
    return settle(_top_stops(spark, sf_dir))


def q_stop_top_n_kpis(spark, sf_dir):
    """AGG-12."""
    return settle(R.top_stop_kpis(_top_stops(spark, sf_dir)))


def q_stop_top_n_table(spark, sf_dir):
    """WIN-1, PRJ-16."""
    return R.top_stop_table(_top_stops(spark, sf_dir))


def q_stop_scatter(spark, sf_dir):
    """PRJ-17."""
    return settle(R.stop_scatter(_top_stops(spark, sf_dir)))


def q_band_kpis(spark, sf_dir):
    """AGG-13, FLT-6 (bands 07-09 and 17-19)."""
    return settle(R.band_kpis(route_hourly(spark, sf_dir), AB_SPEC))


def q_band_kpis_overlapping(spark, sf_dir):
    """AGG-13 with overlapping bands 06-10 and 07-09."""
    return settle(R.band_kpis(route_hourly(spark, sf_dir), AB_SPEC, "06-10", "07-09"))


def q_band_route_scores(spark, sf_dir):
    """AGG-14, JOIN-1, JOIN-2."""
    return settle(R.band_route_scores(route_hourly(spark, sf_dir), AB_SPEC))


def q_band_route_comparison(spark, sf_dir):
    """JOIN-1 display table, PRJ-16."""
    return R.band_comparison_table(R.band_route_scores(route_hourly(spark, sf_dir), AB_SPEC))


def q_band_route_long(spark, sf_dir):
    """SET-1, PRJ-15."""
    return settle(R.band_route_long(R.band_route_scores(route_hourly(spark, sf_dir), AB_SPEC)))


def _new_place(spark, name: str) -> str:
    return f"{shared_dir(spark)}/probelens-{name}-{uuid.uuid4().hex}"


def _items(spark, sf_dir, stamp, since: str | None = None):
    """Items of both grains from one read of the events: the base is written once."""
    r = readings(spark, sf_dir)
    if since is not None:
        r = r.where(F.col("timestamp_dt") >= F.to_timestamp_ntz(F.lit(since)))
    root = _new_place(spark, "base")
    TB.write_base(A.hourly_cell_base(r), root)
    b = TB.read_base(spark, root)
    return S.summary_items(A.route_delay_daily(b), A.route_delay_by_hour(b), stamp)


def q_summary_items(spark, sf_dir):
    """PRJ-12, PRJ-13, PRJ-14, SET-2."""
    return settle(_items(spark, sf_dir, UPSERT_OLD_STAMP))


def q_summary_upsert(spark, sf_dir):
    """SNK-3: a full load, then a refresh of 2024-01-20 and later."""
    old = S.upsert(None, _items(spark, sf_dir, UPSERT_OLD_STAMP))
    new = _items(spark, sf_dir, UPSERT_NEW_STAMP, since=UPSERT_PARTIAL_FROM)
    return settle(S.upsert(old, new))


def q_summary_load_report(spark, sf_dir):
    """SNK-4."""
    return S.load_report(_items(spark, sf_dir, UPSERT_OLD_STAMP))


def _events_with_id(spark, sf_dir):
    return spark.read.schema(T.StructType([*EVENTS_SCHEMA.fields, T.StructField("event_id", T.LongType())])).parquet(events_path(sf_dir))


def q_text_time_readings(spark, sf_dir):
    """PRJ-1, VAL-3 on raw text times, with fixed shares of bad times and missing values."""
    spoiled = lambda n: F.col("event_id") % n == 0
    typed = readings_from_events(_events_with_id(spark, sf_dir), keep=("event_id",))
    raw = raw_text_timestamp(typed).drop("timestamp_dt")
    raw = raw.withColumns(
        {
            "Timestamp": F.when(spoiled(BAD_TIME), F.lit("not a time")).otherwise(F.col("Timestamp")),
            "Speed": F.when(~spoiled(NO_SPEED), F.col("Speed")),
            "Operatorname": F.when(~spoiled(NO_OPERATOR), F.col("Operatorname")),
        }
    )
    return clean_readings(raw).select(
        "event_id",
        F.date_format("timestamp_dt", "yyyy-MM-dd HH:mm:ss").alias("timestamp_dt"),
        "date",
        "hour",
        "weekday",
        "Delay",
        "Journey_Pattern_ID",
    )


def _write_csv(raw, path: str) -> None:
    """Raw readings as CSV text with the declared header; columns that are absent are empty."""
    raw.select(*[(F.col(f.name) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in C.RAW_SCHEMA.fields]).write.option("header", True).csv(path)


def q_csv_route_hourly(spark, sf_dir):
    """SRC-1, VAL-1, VAL-2, VAL-3: the events as raw CSV text, scanned back and aggregated."""
    path = _new_place(spark, "csv")
    _write_csv(raw_text_timestamp(read_event_readings(spark, sf_dir)), path)
    return settle(A.route_delay_by_hour(A.hourly_cell_base(clean_readings(I.load_probe_csv(spark, path).df))))


def _built(spark, sf_dir):
    root = _new_place(spark, "build")
    build_from_events(spark, sf_dir, root)
    return root


def q_build_route_hourly(spark, sf_dir):
    """PIPE-1, SNK-1, SRC-3: the written hourly route table, read back."""
    return settle(TB.read_route_hourly(spark, _built(spark, sf_dir)))


def q_build_route_daily(spark, sf_dir):
    """PIPE-1, SNK-1: the written daily route table, read back."""
    return settle(TB.read_route_daily(spark, _built(spark, sf_dir)))


def q_build_stop_hourly(spark, sf_dir):
    """PIPE-1, SNK-1, SRC-4: the written hourly stop table, read back."""
    return settle(TB.read_stop_hourly(spark, _built(spark, sf_dir)))


def _refreshed(spark, sf_dir):
    root = _new_place(spark, "refresh")
    return refresh(spark, f"{root}/curated", sf_dir=sf_dir, summary_root=f"{root}/summary", updated_at=UPSERT_OLD_STAMP)


def q_refresh_summary(spark, sf_dir):
    """PIPE-2, SNK-3: a refresh with a summary load, and the summary it wrote."""
    return settle(S.read_summary(spark, _refreshed(spark, sf_dir)["summary"]["path"]))


def q_summary_load_report_by_grain(spark, sf_dir):
    """SNK-4: the load report of a refresh, per grain, counted in the files it committed."""
    return S.committed_report(spark, _refreshed(spark, sf_dir)["summary"]["path"])


def q_summary_rejects(spark, sf_dir):
    """SNK-4, D8: the rows a load could not store, with grain and reason."""
    return settle(S.read_rejects(spark, _refreshed(spark, sf_dir)["summary"]["path"]))


def q_summary_versions(spark, sf_dir):
    """SNK-3: a full load and a load of 2024-01-20 and later, written and published; what readers see."""
    root = _new_place(spark, "versions")
    build_from_events(spark, sf_dir, f"{root}/curated")
    load_summary(spark, f"{root}/curated", f"{root}/summary", UPSERT_OLD_STAMP)
    since = F.col("aggregation_date") >= F.lit(UPSERT_PARTIAL_FROM).cast("date")
    daily, hourly = TB.read_route_daily(spark, f"{root}/curated"), TB.read_route_hourly(spark, f"{root}/curated")
    S.write_upsert(spark, f"{root}/summary", {"daily": S.daily_items(daily.where(since), UPSERT_NEW_STAMP), "hourly": S.hourly_items(hourly.where(since), UPSERT_NEW_STAMP)})
    return settle(S.read_summary(spark, f"{root}/summary"))


def _mounted(spark, folder: str) -> str:
    """A folder under another scheme: a mount table of its own that maps to it."""
    name = f"probelens{uuid.uuid4().hex[:12]}"
    spark.conf.set(f"fs.viewfs.mounttable.{name}.link./store", qualified(spark, make_folder(spark, folder)))
    return f"viewfs://{name}/store"


def q_mounted_route_hourly(spark, sf_dir):
    """SRC-2, SNK-2: CSV, build and read-back through a file system that is not local."""
    store = _mounted(spark, _new_place(spark, "mounted"))
    _write_csv(raw_text_timestamp(read_event_readings(spark, sf_dir)), f"{store}/raw")
    build_from_csv(spark, f"{store}/raw", f"{store}/curated")
    return settle(TB.read_route_hourly(spark, f"{store}/curated"))


def q_mounted_summary(spark, sf_dir):
    """SNK-2, SNK-3: a refresh and a second load through a file system that is not local."""
    store = _mounted(spark, _new_place(spark, "mounted"))
    refresh(spark, f"{store}/curated", sf_dir=sf_dir, summary_root=f"{store}/summary", updated_at=UPSERT_NEW_STAMP)
    load_summary(spark, f"{store}/curated", f"{store}/summary", UPSERT_OLD_STAMP)
    return settle(S.read_summary(spark, f"{store}/summary"))


def q_csv_rejected_rows(spark, sf_dir):
    """VAL-3, N1: the rows of spoiled CSV text that are dropped, counted by reason."""
    spoiled = lambda n: F.col("event_id") % n == 0
    raw = raw_text_timestamp(readings_from_events(_events_with_id(spark, sf_dir), keep=("event_id",)))
    raw = raw.withColumns(
        {
            "Speed": F.when(spoiled(NO_SPEED), F.lit("fast")).otherwise(F.col("Speed").cast("string")),
            "Operatorname": F.when(~spoiled(NO_OPERATOR), F.col("Operatorname")),
            "Longitude": F.when(~spoiled(NO_LONGITUDE), F.col("Longitude")),
        }
    )
    path = _new_place(spark, "csv")
    _write_csv(raw, path)
    return I.rejected_rows(spark, path).groupBy("reason").agg(F.count("*").alias("n_rows"), F.count("record").alias("n_records"))


def _placed(df):
    """The rows with their place in the order they come in (one partition)."""
    return settle(df).withColumn("place", F.monotonically_increasing_id() + 1)


def q_overview_by_date_in_order(spark, sf_dir):
    """SRT-1: the series with the place of each row."""
    return _placed(R.overview_by_date(route_hourly(spark, sf_dir), OVERVIEW_SPEC))


def q_overview_by_hour_in_order(spark, sf_dir):
    """SRT-2: the series with the place of each row."""
    return _placed(R.overview_by_hour(route_hourly(spark, sf_dir), OVERVIEW_SPEC))


def _overview_cells(spark, sf_dir):
    return R.overview_from_cells(R.hour_cells(route_hourly(spark, sf_dir), OVERVIEW_SPEC, "overview"))


def _route_state(spark, sf_dir):
    return R.route_from_state(R.route_tab_state(route_hourly(spark, sf_dir), ROUTE_SPEC))


def _band_state(spark, sf_dir):
    return R.band_from_state(R.band_route_state(route_hourly(spark, sf_dir), AB_SPEC))


def q_overview_kpis_from_cells(spark, sf_dir):
    """AGG-4 as the dashboard computes it."""
    return settle(_overview_cells(spark, sf_dir)["kpis"])


def q_overview_by_date_from_cells(spark, sf_dir):
    """AGG-5 as the dashboard computes it."""
    return settle(_overview_cells(spark, sf_dir)["by_date"])


def q_overview_by_hour_from_cells(spark, sf_dir):
    """AGG-6 as the dashboard computes it."""
    return settle(_overview_cells(spark, sf_dir)["by_hour"])


def q_route_kpis_from_state(spark, sf_dir):
    """AGG-7 as the dashboard computes it."""
    return settle(_route_state(spark, sf_dir)["kpis"])


def q_route_delay_by_date_from_state(spark, sf_dir):
    """AGG-8 as the dashboard computes it."""
    return settle(_route_state(spark, sf_dir)["delay_by_date"])


def q_route_delay_by_hour_from_state(spark, sf_dir):
    """AGG-9 as the dashboard computes it."""
    return settle(_route_state(spark, sf_dir)["delay_by_hour"])


def q_route_top10_from_state(spark, sf_dir):
    """AGG-10, TOP-1 as the dashboard computes it."""
    return settle(_route_state(spark, sf_dir)["top_routes"])


def q_band_kpis_from_state(spark, sf_dir):
    """AGG-13 as the dashboard computes it."""
    return settle(_band_state(spark, sf_dir)["kpis"])


def q_band_route_scores_from_state(spark, sf_dir):
    """AGG-14, JOIN-1 as the dashboard computes it."""
    return settle(_band_state(spark, sf_dir)["route_scores"])


def q_band_kpis_empty(spark, sf_dir):
    """AGG-13 with a band that holds no row: null measures, score and delta."""
    return settle(R.band_kpis(route_hourly(spark, sf_dir), AB_SPEC, band_b=NO_HOUR_BAND))


def q_overview_kpis_from_selection(spark, sf_dir):
    """FLT-7, FLT-8, FLT-9: the filters as the dashboard's widgets give them."""
    names = [n for n, number in C.WEEKDAY_NUMBERS.items() if number <= 5]
    spec = FilterSpec.from_selection(("2024-01-03", "2024-01-27"), names, None, ["06-10", "16-20"], C.ALL_CHOICE)
    return settle(R.overview_kpis(route_hourly(spark, sf_dir), spec))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "derived_readings": q_derived_readings,
    "route_delay_daily": q_route_delay_daily,
    "route_delay_by_hour": q_route_delay_by_hour,
    "stop_congestion_hourly": q_stop_congestion_hourly,
    "overview_kpis": q_overview_kpis,
    "overview_by_date": q_overview_by_date,
    "overview_by_hour": q_overview_by_hour,
    "overview_by_date_table": q_overview_by_date_table,
    "route_choices": q_route_choices,
    "operator_choices": q_operator_choices,
    "route_kpis": q_route_kpis,
    "route_delay_by_date": q_route_delay_by_date,
    "route_delay_by_hour_of_day": q_route_delay_by_hour_of_day,
    "route_top10_delay": q_route_top10_delay,
    "route_detail_first100": q_route_detail_first100,
    "stop_top_n": q_stop_top_n,
    "stop_top_n_kpis": q_stop_top_n_kpis,
    "stop_top_n_table": q_stop_top_n_table,
    "stop_scatter": q_stop_scatter,
    "band_kpis": q_band_kpis,
    "band_kpis_overlapping": q_band_kpis_overlapping,
    "band_route_scores": q_band_route_scores,
    "band_route_comparison": q_band_route_comparison,
    "band_route_long": q_band_route_long,
    "summary_items": q_summary_items,
    "summary_upsert": q_summary_upsert,
    "summary_load_report": q_summary_load_report,
    "text_time_readings": q_text_time_readings,
    "csv_route_hourly": q_csv_route_hourly,
    "build_route_hourly": q_build_route_hourly,
    "build_route_daily": q_build_route_daily,
    "build_stop_hourly": q_build_stop_hourly,
    "refresh_summary": q_refresh_summary,
    "summary_load_report_by_grain": q_summary_load_report_by_grain,
    "summary_rejects": q_summary_rejects,
    "summary_versions": q_summary_versions,
    "mounted_route_hourly": q_mounted_route_hourly,
    "mounted_summary": q_mounted_summary,
    "csv_rejected_rows": q_csv_rejected_rows,
    "overview_by_date_in_order": q_overview_by_date_in_order,
    "overview_by_hour_in_order": q_overview_by_hour_in_order,
    "overview_kpis_from_cells": q_overview_kpis_from_cells,
    "overview_by_date_from_cells": q_overview_by_date_from_cells,
    "overview_by_hour_from_cells": q_overview_by_hour_from_cells,
    "route_kpis_from_state": q_route_kpis_from_state,
    "route_delay_by_date_from_state": q_route_delay_by_date_from_state,
    "route_delay_by_hour_from_state": q_route_delay_by_hour_from_state,
    "route_top10_from_state": q_route_top10_from_state,
    "band_kpis_from_state": q_band_kpis_from_state,
    "band_route_scores_from_state": q_band_route_scores_from_state,
    "band_kpis_empty": q_band_kpis_empty,
    "overview_kpis_from_selection": q_overview_kpis_from_selection,
}
