"""Adapter from the driver's ``events`` table to raw probe readings.

The ``events`` table (event_id, ts, user_id, event_type, value, props)
has a time, an entity and a measure, so it stands in for probe readings.
The mapping below is fixed and is the same in the SQL oracle:

* ``timestamp_dt`` = ``ts``: a typed time, so no text is formatted or
  parsed per row (:func:`raw_text_timestamp` gives the raw text form when
  a CSV-shaped copy is wanted). It stays a wall-clock time
  (``TIMESTAMP_NTZ``, as stored): converting it to the session time zone
  would move readings in a daylight-saving gap to the next hour whenever
  the session zone observes DST
* ``Speed``        = ``cast(floor(value / 2) as int)``
* ``Operatorname`` = ``'A'`` for event types click and view, else ``'B'``
* ``CellID``       = ``user_id % 25``, except residue 24 which becomes null
  (exercises the null-route path)
* ``Longitude``, ``Latitude`` = constants (validated, never used after)

Every row of ``events`` becomes one reading: no row is filtered here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probelens import config as C
from probelens.functions.derive import format_timestamp

# Fixed values of the adapter.
OPERATOR_A_EVENT_TYPES = ("click", "view")
CELL_MODULUS = 25
NULL_CELL_RESIDUE = 24
CONSTANT_LONGITUDE = -6.26
CONSTANT_LATITUDE = 53.35


def events_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


def readings_from_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Map ``events`` rows onto the raw probe columns the adapter can fill.

    Raw columns the events cannot supply (radio measurements) are left out
    rather than filled with nulls; no operator reads them. ``keep`` names
    columns of ``events`` to carry along.
    """
    cell = F.col("user_id") % CELL_MODULUS
    mapped = {
        "Longitude": F.lit(CONSTANT_LONGITUDE),
        "Latitude": F.lit(CONSTANT_LATITUDE),
        "Speed": F.floor(F.col("value") / 2).cast("int"),
        "Operatorname": F.when(F.col("event_type").isin(*OPERATOR_A_EVENT_TYPES), F.lit("A")).otherwise(
            F.lit("B")
        ),
        "CellID": F.when(cell == NULL_CELL_RESIDUE, F.lit(None)).otherwise(cell).cast("int"),
    }
    types = {f.name: f.dataType for f in C.RAW_SCHEMA.fields}
    cols = [mapped[name].cast(types[name]).alias(name) for name in types if name in mapped]
    cols.append(F.col("ts").cast("timestamp_ntz").alias("timestamp_dt"))
    return events.select(*keep, *cols)


def raw_text_timestamp(df: DataFrame) -> DataFrame:
    """Add the raw ``Timestamp`` text (``yyyy.MM.dd_HH.mm.ss``) from ``timestamp_dt``."""
    return df.withColumn("Timestamp", format_timestamp("timestamp_dt"))


def required_columns(df: DataFrame) -> tuple[str, ...]:
    """VAL-3's columns; a typed time stands in for the raw time text."""
    if "timestamp_dt" not in df.columns:
        return C.REQUIRED_COLUMNS
    return tuple("timestamp_dt" if c == "Timestamp" else c for c in C.REQUIRED_COLUMNS)


# The columns of ``events`` the adapter reads, with their stored types.
EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("ts", T.TimestampNTZType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("value", T.DoubleType(), True),
    ]
)


def read_event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw probe readings from ``<sf_dir>/events.parquet``.

    The declared read schema skips footer-based schema inference and
    limits the scan to the four columns the mapping uses.
    """
    return readings_from_events(spark.read.schema(EVENTS_SCHEMA).parquet(events_path(sf_dir)))
