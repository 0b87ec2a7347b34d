"""Per-row derivations (PRJ-1 ... PRJ-9, PRJ-11, PRJ-12).

All of these are built-in Column expressions, so they stay inside
whole-stage codegen and cost one projection over the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probelens import config as C


def parse_timestamp(text: Column | str) -> Column:
    """PRJ-1: raw ``yyyy.MM.dd_HH.mm.ss`` text to a timestamp.

    ``try_to_timestamp`` gives null for text that does not parse, whether
    or not ANSI mode is on, so one bad reading never fails the job (N4).
    """
    return F.try_to_timestamp(_col(text), F.lit(C.TIMESTAMP_PATTERN))


def format_timestamp(ts: Column | str) -> Column:
    """Inverse of :func:`parse_timestamp` (whole seconds)."""
    return F.date_format(_col(ts), C.TIMESTAMP_PATTERN)


def congestion_flag(speed: Column | str = "Speed") -> Column:
    """PRJ-6: 1 when speed is at or below the congestion threshold, else 0."""
    return F.when(_col(speed) <= C.CONGESTION_SPEED_THRESHOLD, F.lit(1)).otherwise(F.lit(0))


def delay_estimate(speed: Column | str = "Speed") -> Column:
    """PRJ-7: seconds of delay, ``(normal - speed) * 2`` below normal speed, else 0."""
    s = _col(speed)
    return F.when(
        s < C.NORMAL_SPEED, (F.lit(C.NORMAL_SPEED) - s) * C.DELAY_SECONDS_PER_KMH
    ).otherwise(F.lit(0))


def route_key(operator: Column | str = "Operatorname", cell: Column | str = "CellID") -> Column:
    """PRJ-8: ``<operator>_<cell>``; null when either part is null (``concat``)."""
    return F.concat(_col(operator), F.lit("_"), _col(cell).cast("string"))


def stop_key(cell: Column | str = "CellID") -> Column:
    """PRJ-9: the cell id as text."""
    return _col(cell).cast("string")


def iso_weekday(day: Column | str) -> Column:
    """Monday=1 ... Sunday=7 (the dashboard's numbering, FLT-8)."""
    return F.weekday(_col(day)) + F.lit(1)


def congestion_score(rate: Column | str) -> Column:
    """PRJ-11: clamp a rate into [0, 100].

    A null rate gives 0, as the source's ``max(0, x)`` does for a missing
    value; a NaN rate is treated the same way (N6) instead of reaching 100.
    """
    r = F.nanvl(_col(rate).cast("double"), F.lit(None).cast("double"))
    return F.least(F.lit(C.SCORE_MAX), F.greatest(F.lit(C.SCORE_MIN), F.coalesce(r, F.lit(0.0))))


def time_bucket(day: Column | str, hour: Column | str | None = None) -> Column:
    """PRJ-12: ``YYYY-MM-DD`` or, with an hour, ``YYYY-MM-DD-HH``.

    Null when the date (or the hour, if given) is null.
    """
    d = F.date_format(_col(day), "yyyy-MM-dd")
    if hour is None:
        return d
    return F.concat(d, F.lit("-"), F.lpad(_col(hour).cast("string"), 2, "0"))


def time_part_columns(ts: Column | str = "timestamp_dt") -> dict[str, Column]:
    """PRJ-2 ... PRJ-5: ``date``, year/month/day/hour, weekday of a timestamp.

    ``weekday`` keeps Sunday=1 ... Saturday=7 (``dayofweek``), the ETL's
    numbering; filters use :func:`iso_weekday` on the date instead (D4).
    """
    t = _col(ts)
    return {
        "date": t.cast("date"),
        "year": F.year(t),
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "hour": F.hour(t),
        "weekday": F.dayofweek(t),
    }


def measure_columns() -> dict[str, Column]:
    """PRJ-6 ... PRJ-9: congestion flag, delay, route and stop keys."""
    return {
        "Congestion": congestion_flag("Speed"),
        "Delay": delay_estimate("Speed"),
        "Journey_Pattern_ID": route_key("Operatorname", "CellID"),
        "Stop_ID": stop_key("CellID"),
    }


def derive_readings(df: DataFrame) -> DataFrame:
    """All per-row derivations of the ETL.

    Raw text is parsed once into ``timestamp_dt``; a typed source that
    already carries ``timestamp_dt`` (see :mod:`probelens.sources.events`)
    skips the parse. The other derived columns are one further projection.
    """
    return _with_timestamp(df).withColumns({**time_part_columns(), **measure_columns()})


def _with_timestamp(df: DataFrame) -> DataFrame:
    if "timestamp_dt" in df.columns:
        return df
    return df.withColumns({"timestamp_dt": parse_timestamp("Timestamp")})


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
