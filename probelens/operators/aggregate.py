"""Curated aggregates (AGG-1, AGG-2, AGG-3) from one shared scan.

The three curated tables share one grain. The route key is
``<operator>_<cell>`` and the stop key is ``<cell>``, and both are grouped
together with the operator, so the groups of ``(route, date, hour,
operator)`` and ``(stop, date, hour, operator)`` are the groups of
``(CellID, date, hour, Operatorname)``. The daily route table is the same
grain without the hour.

So the raw readings are aggregated **once**, to an *hourly cell base* that
keeps mergeable state (count, integer sums, max, min). Partial aggregation
runs map-side, so each task ships at most one row per group it saw: a key
holding a third of all readings costs no more shuffle than any other. The
three tables are then projections (hourly) and a roll-up (daily) of the
base, which is orders of magnitude smaller than the readings.

Averages are integer sums divided by counts. Spark's ``avg`` over an int
column sums in double, which is exact for integers below 2**53, so
``sum / count`` gives bit-identical averages to ``avg`` on the readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probelens.functions.derive import route_key, stop_key

BASE_KEYS = ("CellID", "date", "hour", "Operatorname")

BASE_STATE = ("n", "congestion_sum", "delay_sum", "delay_max", "delay_min", "speed_sum")


def hourly_cell_base(readings: DataFrame) -> DataFrame:
    """Aggregate derived readings to the shared hourly grain.

    Null keys form their own groups (N2): a reading without a cell, or
    without a parseable time, is kept in a null-key group.
    """
    return readings.groupBy(*BASE_KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("Congestion").cast("bigint").alias("congestion_sum"),
        F.sum("Delay").cast("bigint").alias("delay_sum"),
        F.max("Delay").alias("delay_max"),
        F.min("Delay").alias("delay_min"),
        F.sum("Speed").cast("bigint").alias("speed_sum"),
    )


def _rate(congestion: Column, n: Column) -> Column:
    """Congested share in percent: ``sum / count * 100``."""
    return congestion / n * F.lit(100)


def route_delay_by_hour(base: DataFrame) -> DataFrame:
    """AGG-2: route delay per hour, plus ``avg_speed`` (D6)."""
    return base.select(
        route_key("Operatorname", "CellID").alias("Journey_Pattern_ID"),
        F.col("date").alias("aggregation_date"),
        "hour",
        "Operatorname",
        (F.col("delay_sum") / F.col("n")).alias("avg_delay"),
        F.col("delay_max").alias("max_delay"),
        F.col("delay_min").alias("min_delay"),
        F.col("n").alias("trip_count"),
        F.col("congestion_sum").alias("congestion_count"),
        _rate(F.col("congestion_sum"), F.col("n")).alias("congestion_rate"),
        (F.col("speed_sum") / F.col("n")).alias("avg_speed"),
    )


def route_delay_daily(base: DataFrame) -> DataFrame:
    """AGG-1: route delay per day, a roll-up of the hourly base."""
    daily = base.groupBy("CellID", "date", "Operatorname").agg(
        F.sum("n").alias("n"),
        F.sum("congestion_sum").alias("congestion_sum"),
        F.sum("delay_sum").alias("delay_sum"),
        F.max("delay_max").alias("max_delay"),
        F.min("delay_min").alias("min_delay"),
    )
    return daily.select(
        route_key("Operatorname", "CellID").alias("Journey_Pattern_ID"),
        F.col("date").alias("aggregation_date"),
        "Operatorname",
        (F.col("delay_sum") / F.col("n")).alias("avg_delay"),
        "max_delay",
        "min_delay",
        F.col("n").alias("trip_count"),
        F.col("congestion_sum").alias("congestion_count"),
        _rate(F.col("congestion_sum"), F.col("n")).alias("congestion_rate"),
    )


def stop_congestion_hourly(base: DataFrame) -> DataFrame:
    """AGG-3: stop congestion per hour."""
    return base.select(
        stop_key("CellID").alias("Stop_ID"),
        F.col("date").alias("aggregation_date"),
        "hour",
        "Operatorname",
        F.col("n").alias("total_count"),
        F.col("congestion_sum").alias("congestion_count"),
        _rate(F.col("congestion_sum"), F.col("n")).alias("congestion_rate"),
        (F.col("speed_sum") / F.col("n")).alias("avg_speed"),
        (F.col("delay_sum") / F.col("n")).alias("avg_delay"),
    )


def curated_tables(readings: DataFrame) -> dict[str, DataFrame]:
    """All three curated tables from derived readings (lazy).

    When the results are to be kept, write the base first and build the
    tables from the written base (see :mod:`probelens.plans.pipeline`); as
    plain lazy frames each table re-reads the readings.
    """
    base = hourly_cell_base(readings)
    return {
        "route_delay_daily": route_delay_daily(base),
        "route_delay_by_hour": route_delay_by_hour(base),
        "stop_congestion_hourly": stop_congestion_hourly(base),
    }
