"""Fixed values of the probe data model.

Everything here is a contract value: the raw CSV layout, the thresholds
that turn a speed into a congestion flag and a delay, the text formats of
time stamps and summary keys, and the dashboard's selectable bands. They
are plain constants so that a reader can check them against the source
data contract in one place.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source application's for equal results)
# ---------------------------------------------------------------------------

# Raw probe CSV: column order as in the files; all nullable; no inference.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("Timestamp", T.StringType(), True),
        T.StructField("Longitude", T.DoubleType(), True),
        T.StructField("Latitude", T.DoubleType(), True),
        T.StructField("Speed", T.IntegerType(), True),
        T.StructField("Operatorname", T.StringType(), True),
        T.StructField("CellID", T.IntegerType(), True),
        T.StructField("NetworkMode", T.StringType(), True),
        T.StructField("RSRP", T.IntegerType(), True),
        T.StructField("RSRQ", T.IntegerType(), True),
        T.StructField("SNR", T.FloatType(), True),
        T.StructField("CQI", T.IntegerType(), True),
        T.StructField("RSSI", T.StringType(), True),
        T.StructField("DL_bitrate", T.IntegerType(), True),
        T.StructField("UL_bitrate", T.IntegerType(), True),
        T.StructField("State", T.StringType(), True),
        T.StructField("NRxRSRP", T.StringType(), True),
        T.StructField("NRxRSRQ", T.StringType(), True),
        T.StructField("ServingCell_Lon", T.StringType(), True),
        T.StructField("ServingCell_Lat", T.StringType(), True),
        T.StructField("ServingCell_Distance", T.StringType(), True),
    ]
)

# Rows missing any of these are dropped before derivation.
REQUIRED_COLUMNS = ("Timestamp", "Longitude", "Latitude", "Speed", "Operatorname")

# Text layout of the raw Timestamp column (Spark datetime pattern).
TIMESTAMP_PATTERN = "yyyy.MM.dd_HH.mm.ss"

# Speed (km/h) at or below which a reading counts as congested.
CONGESTION_SPEED_THRESHOLD = 5
# Speed (km/h) taken as normal; below it a delay is estimated.
NORMAL_SPEED = 30
# Seconds of delay per km/h below normal speed.
DELAY_SECONDS_PER_KMH = 2

# Congestion score is the rate clamped into this range.
SCORE_MIN = 0.0
SCORE_MAX = 100.0

# Dashboard defaults and choices.
DEFAULT_DATE_RANGE = (_dt.date(2017, 11, 30), _dt.date(2018, 1, 27))
ALL_CHOICE = "전체"  # "all": selecting it means no predicate
DEFAULT_BAND_A = "07-09"
DEFAULT_BAND_B = "17-19"
DEFAULT_LABEL_A = "출근 시간"  # morning commute
DEFAULT_LABEL_B = "퇴근 시간"  # evening commute
# Weekday names as offered by the dashboard, Monday=1 ... Sunday=7.
WEEKDAY_NUMBERS = {"월": 1, "화": 2, "수": 3, "목": 4, "금": 5, "토": 6, "일": 7}
TOP_N_MIN, TOP_N_MAX, TOP_N_DEFAULT = 5, 50, 10
TOP_ROUTES = 10
DETAIL_ROWS = 100

# Summary table: key columns and the placeholder for an absent text field.
SUMMARY_KEY = ("route_id", "time_bucket")
SUMMARY_UNKNOWN = "unknown"

# ---------------------------------------------------------------------------
# Curated table layouts (column order as written)
# ---------------------------------------------------------------------------

ROUTE_MEASURES = (
    "avg_delay",
    "max_delay",
    "min_delay",
    "trip_count",
    "congestion_count",
    "congestion_rate",
)

ROUTE_DAILY_SCHEMA = T.StructType(
    [
        T.StructField("Journey_Pattern_ID", T.StringType(), True),
        T.StructField("Operatorname", T.StringType(), True),
        T.StructField("avg_delay", T.DoubleType(), True),
        T.StructField("max_delay", T.IntegerType(), True),
        T.StructField("min_delay", T.IntegerType(), True),
        T.StructField("trip_count", T.LongType(), True),
        T.StructField("congestion_count", T.LongType(), True),
        T.StructField("congestion_rate", T.DoubleType(), True),
        T.StructField("aggregation_date", T.DateType(), True),
    ]
)

ROUTE_HOURLY_SCHEMA = T.StructType(
    [
        T.StructField("Journey_Pattern_ID", T.StringType(), True),
        T.StructField("hour", T.IntegerType(), True),
        T.StructField("Operatorname", T.StringType(), True),
        T.StructField("avg_delay", T.DoubleType(), True),
        T.StructField("max_delay", T.IntegerType(), True),
        T.StructField("min_delay", T.IntegerType(), True),
        T.StructField("trip_count", T.LongType(), True),
        T.StructField("congestion_count", T.LongType(), True),
        T.StructField("congestion_rate", T.DoubleType(), True),
        T.StructField("avg_speed", T.DoubleType(), True),
        T.StructField("aggregation_date", T.DateType(), True),
    ]
)

STOP_HOURLY_SCHEMA = T.StructType(
    [
        T.StructField("Stop_ID", T.StringType(), True),
        T.StructField("hour", T.IntegerType(), True),
        T.StructField("Operatorname", T.StringType(), True),
        T.StructField("total_count", T.LongType(), True),
        T.StructField("congestion_count", T.LongType(), True),
        T.StructField("congestion_rate", T.DoubleType(), True),
        T.StructField("avg_speed", T.DoubleType(), True),
        T.StructField("avg_delay", T.DoubleType(), True),
        T.StructField("aggregation_date", T.DateType(), True),
    ]
)

SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("route_id", T.StringType(), True),
        T.StructField("time_bucket", T.StringType(), True),
        T.StructField("operator", T.StringType(), True),
        T.StructField("avg_delay", T.DoubleType(), True),
        T.StructField("max_delay", T.IntegerType(), True),
        T.StructField("min_delay", T.IntegerType(), True),
        T.StructField("trip_count", T.LongType(), True),
        T.StructField("congestion_count", T.LongType(), True),
        T.StructField("congestion_rate", T.DoubleType(), True),
        T.StructField("updated_at", T.StringType(), True),
    ]
)

# Shared hourly aggregate the curated tables are built from (mergeable state).
HOURLY_BASE_SCHEMA = T.StructType(
    [
        T.StructField("CellID", T.IntegerType(), True),
        T.StructField("date", T.DateType(), True),
        T.StructField("hour", T.IntegerType(), True),
        T.StructField("Operatorname", T.StringType(), True),
        T.StructField("n", T.LongType(), True),
        T.StructField("congestion_sum", T.LongType(), True),
        T.StructField("delay_sum", T.LongType(), True),
        T.StructField("delay_max", T.IntegerType(), True),
        T.StructField("delay_min", T.IntegerType(), True),
        T.StructField("speed_sum", T.LongType(), True),
    ]
)

# Curated table names under an output root.
ROUTE_DAILY = "route_delay_daily"
ROUTE_HOURLY = "route_delay_by_hour"
STOP_HOURLY = "stop_congestion_hourly"
HOURLY_BASE = "_hourly_cell_base"
