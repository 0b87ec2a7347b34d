"""The registered queries as plain SQL for DuckDB (the correctness oracle).

Each string runs on the driver's tables registered as views. The common
table expressions restate the event adapter, the cleaning, the derivation
and the three curated aggregates straight from the readings (no shared
base), so the SQL is an independent statement of the same semantics.

Double results are rounded to 6 decimals like ``catalog.settle``; the
``r(x, k)`` helper rounds half-up on the decimal value, as Spark's ``round``
does, instead of DuckDB's binary ``round``.
"""

from __future__ import annotations


def r(expr: str, k: int = 6) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38, 12)), {k}) AS DOUBLE)"


def score(expr: str) -> str:
    """Rate clamped into [0, 100]; a missing rate gives 0."""
    return f"least(100.0, greatest(0.0, coalesce(CAST({expr} AS DOUBLE), 0.0)))"


_CTE = f"""
WITH raw AS (
    SELECT
        ts AS timestamp_dt,
        CAST(-6.26 AS DOUBLE) AS "Longitude",
        CAST(53.35 AS DOUBLE) AS "Latitude",
        CAST(floor(value / 2) AS INTEGER) AS "Speed",
        CASE WHEN event_type IN ('click', 'view') THEN 'A' ELSE 'B' END AS "Operatorname",
        CASE WHEN user_id % 25 = 24 THEN NULL ELSE CAST(user_id % 25 AS INTEGER) END AS "CellID"
    FROM events
),
readings AS (
    SELECT *
    FROM raw
    WHERE timestamp_dt IS NOT NULL AND "Longitude" IS NOT NULL AND "Latitude" IS NOT NULL
      AND "Speed" IS NOT NULL AND "Operatorname" IS NOT NULL
),
derived AS (
    SELECT *,
        CAST(timestamp_dt AS DATE) AS "date",
        CAST(year(timestamp_dt) AS INTEGER) AS "year",
        CAST(month(timestamp_dt) AS INTEGER) AS "month",
        CAST(day(timestamp_dt) AS INTEGER) AS "day",
        CAST(hour(timestamp_dt) AS INTEGER) AS "hour",
        CAST(dayofweek(timestamp_dt) + 1 AS INTEGER) AS "weekday",
        CASE WHEN "Speed" <= 5 THEN 1 ELSE 0 END AS "Congestion",
        CASE WHEN "Speed" < 30 THEN (30 - "Speed") * 2 ELSE 0 END AS "Delay",
        "Operatorname" || '_' || CAST("CellID" AS VARCHAR) AS "Journey_Pattern_ID",
        CAST("CellID" AS VARCHAR) AS "Stop_ID"
    FROM readings
),
route_hourly AS (
    SELECT "Journey_Pattern_ID", "date" AS aggregation_date, "hour", "Operatorname",
        avg("Delay") AS avg_delay,
        max("Delay") AS max_delay,
        min("Delay") AS min_delay,
        count(*) AS trip_count,
        CAST(sum("Congestion") AS BIGINT) AS congestion_count,
        CAST(sum("Congestion") AS DOUBLE) / count(*) * 100 AS congestion_rate,
        avg("Speed") AS avg_speed
    FROM derived
    GROUP BY "Journey_Pattern_ID", "date", "hour", "Operatorname"
),
route_daily AS (
    SELECT "Journey_Pattern_ID", "date" AS aggregation_date, "Operatorname",
        avg("Delay") AS avg_delay,
        max("Delay") AS max_delay,
        min("Delay") AS min_delay,
        count(*) AS trip_count,
        CAST(sum("Congestion") AS BIGINT) AS congestion_count,
        CAST(sum("Congestion") AS DOUBLE) / count(*) * 100 AS congestion_rate
    FROM derived
    GROUP BY "Journey_Pattern_ID", "date", "Operatorname"
),
stop_hourly AS (
    SELECT "Stop_ID", "date" AS aggregation_date, "hour", "Operatorname",
        count(*) AS total_count,
        CAST(sum("Congestion") AS BIGINT) AS congestion_count,
        CAST(sum("Congestion") AS DOUBLE) / count(*) * 100 AS congestion_rate,
        avg("Speed") AS avg_speed,
        avg("Delay") AS avg_delay
    FROM derived
    GROUP BY "Stop_ID", "date", "hour", "Operatorname"
)"""

# Filter predicates of the registered queries (see catalog.py).
_OVERVIEW_WHERE = """aggregation_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-27'
      AND isodow(aggregation_date) IN (1, 2, 3, 4, 5)
      AND ("hour" BETWEEN 6 AND 10 OR "hour" BETWEEN 16 AND 20)"""
_ROUTE_WHERE = """aggregation_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
      AND "hour" BETWEEN 0 AND 23
      AND "Operatorname" = 'A'"""
_ROUTE_SELECTED_WHERE = """aggregation_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'
      AND isodow(aggregation_date) IN (6, 7)
      AND "Journey_Pattern_ID" IN ('A_1', 'A_2', 'A_3', 'B_4', 'B_7')
      AND "hour" BETWEEN 0 AND 23"""
_ROUTE_ALL_OPS_WHERE = """aggregation_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
      AND "hour" BETWEEN 0 AND 23"""
_STOP_WHERE = """aggregation_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
      AND "hour" BETWEEN 7 AND 22
      AND "Operatorname" = 'B'"""
_AB_WHERE = """aggregation_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'"""


def _q(body: str) -> str:
    return f"{_CTE}\n{body}"


_TOP_STOPS = f"""
, top_stops AS (
    SELECT "Stop_ID",
        avg(congestion_rate) AS congestion_rate,
        CAST(sum(congestion_count) AS BIGINT) AS congestion_count,
        CAST(sum(total_count) AS BIGINT) AS total_count,
        avg(avg_speed) AS avg_speed,
        avg(avg_delay) AS avg_delay
    FROM stop_hourly
    WHERE {_STOP_WHERE} AND "Stop_ID" IS NOT NULL
    GROUP BY "Stop_ID"
    ORDER BY congestion_rate DESC, "Stop_ID" ASC
    LIMIT 10
)"""


def _band_scores(a: tuple[int, int], b: tuple[int, int]) -> str:
    return f"""
, per_route AS (
    SELECT "Journey_Pattern_ID",
        avg(CASE WHEN "hour" BETWEEN {a[0]} AND {a[1]} THEN congestion_rate END) AS congestion_rate_a,
        avg(CASE WHEN "hour" BETWEEN {b[0]} AND {b[1]} THEN congestion_rate END) AS congestion_rate_b
    FROM route_hourly
    WHERE {_AB_WHERE} AND "Journey_Pattern_ID" IS NOT NULL
    GROUP BY "Journey_Pattern_ID"
),
band_scores AS (
    SELECT "Journey_Pattern_ID", congestion_rate_a, {score('congestion_rate_a')} AS congestion_score_a,
        congestion_rate_b, {score('congestion_rate_b')} AS congestion_score_b
    FROM per_route
    WHERE congestion_rate_a IS NOT NULL AND congestion_rate_b IS NOT NULL
)"""


def _band_score(expr: str) -> str:
    """A band without a row has no score."""
    return f"(CASE WHEN {expr} IS NOT NULL THEN {score(expr)} END)"


def _band_kpis(a: tuple[int, int], b: tuple[int, int]) -> str:
    return _q(
        f"""
, k AS (
    SELECT
        avg(CASE WHEN "hour" BETWEEN {a[0]} AND {a[1]} THEN congestion_rate END) AS ra,
        avg(CASE WHEN "hour" BETWEEN {b[0]} AND {b[1]} THEN congestion_rate END) AS rb,
        avg(CASE WHEN "hour" BETWEEN {a[0]} AND {a[1]} THEN avg_speed END) AS sa,
        avg(CASE WHEN "hour" BETWEEN {b[0]} AND {b[1]} THEN avg_speed END) AS sb
    FROM route_hourly
    WHERE {_AB_WHERE}
)
SELECT {r('ra')} AS congestion_rate_a, {r(_band_score('ra'))} AS congestion_score_a, {r('sa')} AS avg_speed_a,
    {r('rb')} AS congestion_rate_b, {r(_band_score('rb'))} AS congestion_score_b, {r('sb')} AS avg_speed_b,
    {r(f"{_band_score('rb')} - {_band_score('ra')}")} AS score_delta
FROM k"""
    )


def _items(stamp: str, since: str | None = None) -> str:
    """Summary items from the readings (optionally only those since a time)."""
    where = f"WHERE timestamp_dt >= TIMESTAMP '{since}'" if since else ""
    return f"""(
    SELECT "Journey_Pattern_ID" AS route_id, strftime("date", '%Y-%m-%d') AS time_bucket,
        "Operatorname" AS operator, avg("Delay") AS avg_delay, max("Delay") AS max_delay,
        min("Delay") AS min_delay, count(*) AS trip_count,
        CAST(sum("Congestion") AS BIGINT) AS congestion_count,
        CAST(sum("Congestion") AS DOUBLE) / count(*) * 100 AS congestion_rate,
        '{stamp}' AS updated_at
    FROM derived {where}
    GROUP BY "Journey_Pattern_ID", "date", "Operatorname"
    UNION ALL
    SELECT "Journey_Pattern_ID", strftime("date", '%Y-%m-%d') || '-' || lpad(CAST("hour" AS VARCHAR), 2, '0'),
        "Operatorname", avg("Delay"), max("Delay"), min("Delay"), count(*),
        CAST(sum("Congestion") AS BIGINT),
        CAST(sum("Congestion") AS DOUBLE) / count(*) * 100,
        '{stamp}'
    FROM derived {where}
    GROUP BY "Journey_Pattern_ID", "date", "hour", "Operatorname"
)"""


_ITEM_COLS = f"""route_id, time_bucket, operator, {r('avg_delay')} AS avg_delay, max_delay, min_delay,
    trip_count, congestion_count, {r('congestion_rate')} AS congestion_rate, updated_at"""

_VALID = "route_id IS NOT NULL AND time_bucket IS NOT NULL AND operator IS NOT NULL"

ORACLE_SQL: dict[str, str] = {
    "derived_readings": _q(
        """
SELECT strftime(timestamp_dt, '%Y-%m-%d %H:%M:%S') AS timestamp_dt, "date", "year", "month", "day",
    "hour", "weekday", "Speed", "Operatorname", "CellID", "Congestion", "Delay",
    "Journey_Pattern_ID", "Stop_ID"
FROM derived"""
    ),
    "route_delay_daily": _q(
        f"""
SELECT "Journey_Pattern_ID", aggregation_date, "Operatorname", {r('avg_delay')} AS avg_delay,
    max_delay, min_delay, trip_count, congestion_count, {r('congestion_rate')} AS congestion_rate
FROM route_daily"""
    ),
    "route_delay_by_hour": _q(
        f"""
SELECT "Journey_Pattern_ID", aggregation_date, "hour", "Operatorname", {r('avg_delay')} AS avg_delay,
    max_delay, min_delay, trip_count, congestion_count, {r('congestion_rate')} AS congestion_rate,
    {r('avg_speed')} AS avg_speed
FROM route_hourly"""
    ),
    "stop_congestion_hourly": _q(
        f"""
SELECT "Stop_ID", aggregation_date, "hour", "Operatorname", total_count, congestion_count,
    {r('congestion_rate')} AS congestion_rate, {r('avg_speed')} AS avg_speed, {r('avg_delay')} AS avg_delay
FROM stop_hourly"""
    ),
    "overview_kpis": _q(
        f"""
SELECT {r('avg(congestion_rate)')} AS avg_congestion_rate,
    {r(score('avg(congestion_rate)'))} AS congestion_score,
    {r('avg(congestion_rate)')} AS stop_slow_ratio,
    CAST(sum(trip_count) AS BIGINT) AS total_samples,
    {r('avg(avg_speed)')} AS avg_speed
FROM route_hourly
WHERE {_OVERVIEW_WHERE}"""
    ),
    "overview_by_date": _q(
        f"""
SELECT aggregation_date, {r('avg(congestion_rate)')} AS congestion_rate,
    CAST(sum(trip_count) AS BIGINT) AS trip_count, {r(score('avg(congestion_rate)'))} AS congestion_score
FROM route_hourly
WHERE {_OVERVIEW_WHERE} AND aggregation_date IS NOT NULL
GROUP BY aggregation_date
ORDER BY aggregation_date"""
    ),
    "overview_by_hour": _q(
        f"""
SELECT "hour", {r('avg(congestion_rate)')} AS congestion_rate,
    CAST(sum(trip_count) AS BIGINT) AS trip_count, {r(score('avg(congestion_rate)'))} AS congestion_score
FROM route_hourly
WHERE {_OVERVIEW_WHERE} AND "hour" IS NOT NULL
GROUP BY "hour"
ORDER BY "hour\""""
    ),
    "overview_by_date_table": _q(
        f"""
, series AS (
    SELECT aggregation_date, avg(congestion_rate) AS congestion_rate, CAST(sum(trip_count) AS BIGINT) AS trip_count
    FROM route_hourly
    WHERE {_OVERVIEW_WHERE} AND aggregation_date IS NOT NULL
    GROUP BY aggregation_date
)
SELECT aggregation_date, {r(score('congestion_rate'), 2)} AS congestion_score,
    {r('congestion_rate', 2)} AS congestion_rate, trip_count
FROM series"""
    ),
    "route_choices": _q(
        """
SELECT DISTINCT "Journey_Pattern_ID" FROM route_hourly WHERE "Journey_Pattern_ID" IS NOT NULL
ORDER BY 1"""
    ),
    "operator_choices": _q(
        """
SELECT DISTINCT "Operatorname" FROM route_hourly WHERE "Operatorname" IS NOT NULL
ORDER BY 1"""
    ),
    "route_kpis": _q(
        f"""
SELECT {r('avg(avg_delay)')} AS avg_delay, max(max_delay) AS max_delay,
    CAST(sum(trip_count) AS BIGINT) AS total_trips, {r('avg(congestion_rate)')} AS congestion_rate
FROM route_hourly
WHERE {_ROUTE_SELECTED_WHERE}"""
    ),
    "route_delay_by_date": _q(
        f"""
SELECT aggregation_date, {r('avg(avg_delay)')} AS avg_delay
FROM route_hourly
WHERE {_ROUTE_WHERE} AND aggregation_date IS NOT NULL
GROUP BY aggregation_date
ORDER BY aggregation_date"""
    ),
    "route_delay_by_hour_of_day": _q(
        f"""
SELECT "hour", {r('avg(avg_delay)')} AS avg_delay
FROM route_hourly
WHERE {_ROUTE_WHERE} AND "hour" IS NOT NULL
GROUP BY "hour"
ORDER BY "hour\""""
    ),
    "route_top10_delay": _q(
        f"""
, per_route AS (
    SELECT "Journey_Pattern_ID", avg(avg_delay) AS avg_delay
    FROM route_hourly
    WHERE {_ROUTE_ALL_OPS_WHERE} AND "Journey_Pattern_ID" IS NOT NULL
    GROUP BY "Journey_Pattern_ID"
)
SELECT "Journey_Pattern_ID", {r('avg_delay')} AS avg_delay
FROM per_route
ORDER BY avg_delay DESC, "Journey_Pattern_ID" ASC
LIMIT 10"""
    ),
    "route_detail_first100": _q(
        f"""
SELECT "Journey_Pattern_ID", aggregation_date, "hour", "Operatorname", {r('avg_delay')} AS avg_delay,
    max_delay, min_delay, trip_count, congestion_count, {r('congestion_rate')} AS congestion_rate,
    {r('avg_speed')} AS avg_speed
FROM route_hourly
WHERE {_ROUTE_WHERE}
ORDER BY "Journey_Pattern_ID" ASC NULLS LAST, aggregation_date ASC NULLS LAST,
    "hour" ASC NULLS LAST, "Operatorname" ASC NULLS LAST
LIMIT 100"""
    ),
    "stop_top_n": _q(
        _TOP_STOPS
        + f"""
SELECT "Stop_ID", {r('congestion_rate')} AS congestion_rate, congestion_count, total_count,
    {r('avg_speed')} AS avg_speed, {r('avg_delay')} AS avg_delay,
    {r(score('congestion_rate'))} AS congestion_score
FROM top_stops"""
    ),
    "stop_top_n_kpis": _q(
        _TOP_STOPS
        + f"""
SELECT {r('avg(congestion_rate)')} AS avg_congestion_rate, {r('max(congestion_rate)')} AS max_congestion_rate,
    CAST(sum(congestion_count) AS BIGINT) AS total_congestion_events
FROM top_stops"""
    ),
    "stop_top_n_table": _q(
        _TOP_STOPS
        + f"""
SELECT CAST(row_number() OVER (ORDER BY congestion_rate DESC, "Stop_ID" ASC) AS INTEGER) AS "Rank",
    "Stop_ID", {r('avg_speed', 2)} AS avg_speed, {r('congestion_rate', 2)} AS congestion_rate,
    {r(score('congestion_rate'), 2)} AS congestion_score, total_count AS sample_count
FROM top_stops"""
    ),
    "stop_scatter": _q(
        _TOP_STOPS
        + f"""
SELECT "Stop_ID", {r('avg_speed')} AS avg_speed, {r('congestion_rate')} AS congestion_rate,
    total_count AS size
FROM top_stops"""
    ),
    "band_kpis": _band_kpis((7, 9), (17, 19)),
    "band_kpis_overlapping": _band_kpis((6, 10), (7, 9)),
    "band_route_scores": _q(
        _band_scores((7, 9), (17, 19))
        + f"""
SELECT "Journey_Pattern_ID", {r('congestion_rate_a')} AS congestion_rate_a,
    {r('congestion_score_a')} AS congestion_score_a, {r('congestion_rate_b')} AS congestion_rate_b,
    {r('congestion_score_b')} AS congestion_score_b
FROM band_scores"""
    ),
    "band_route_comparison": _q(
        _band_scores((7, 9), (17, 19))
        + f"""
SELECT "Journey_Pattern_ID", {r('congestion_score_a', 2)} AS congestion_score_a,
    {r('congestion_score_b', 2)} AS congestion_score_b
FROM band_scores"""
    ),
    "band_route_long": _q(
        _band_scores((7, 9), (17, 19))
        + f"""
SELECT "Journey_Pattern_ID", '출근 시간' AS time_period, {r('congestion_rate_a')} AS congestion_rate,
    {r('congestion_score_a')} AS congestion_score
FROM band_scores
UNION ALL
SELECT "Journey_Pattern_ID", '퇴근 시간', {r('congestion_rate_b')}, {r('congestion_score_b')}
FROM band_scores"""
    ),
    "summary_items": _q(
        f"""
SELECT {_ITEM_COLS}
FROM {_items('2024-02-01T00:00:00')} AS items"""
    ),
    "summary_upsert": _q(
        f"""
, old AS (SELECT * FROM {_items('2024-02-01T00:00:00')} AS o WHERE {_VALID}),
new AS (SELECT * FROM {_items('2024-02-02T00:00:00', '2024-01-20 00:00:00')} AS n WHERE {_VALID}),
merged AS (
    SELECT * FROM new
    UNION ALL
    SELECT * FROM old WHERE NOT EXISTS (
        SELECT 1 FROM new WHERE new.route_id = old.route_id AND new.time_bucket = old.time_bucket)
)
SELECT {_ITEM_COLS}
FROM merged"""
    ),
    "summary_load_report": _q(
        f"""
SELECT CAST(count(*) FILTER (WHERE {_VALID}) AS BIGINT) AS success,
    CAST(count(*) FILTER (WHERE NOT ({_VALID})) AS BIGINT) AS failed,
    CAST(count(*) AS BIGINT) AS total
FROM {_items('2024-02-01T00:00:00')} AS items"""
    ),
    "text_time_readings": """
WITH raw AS (
    SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN date_trunc('second', ts) END AS t,
        CASE WHEN event_id % 11 <> 0 THEN CAST(floor(value / 2) AS INTEGER) END AS speed,
        CASE WHEN event_id % 13 <> 0 THEN CASE WHEN event_type IN ('click', 'view') THEN 'A' ELSE 'B' END END AS operator,
        CASE WHEN user_id % 25 <> 24 THEN user_id % 25 END AS cell
    FROM events
    WHERE ts IS NOT NULL OR event_id % 7 = 0
)
SELECT event_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS timestamp_dt, CAST(t AS DATE) AS "date",
    CAST(hour(t) AS INTEGER) AS "hour", CAST(dayofweek(t) + 1 AS INTEGER) AS "weekday",
    CASE WHEN speed < 30 THEN (30 - speed) * 2 ELSE 0 END AS "Delay",
    operator || '_' || CAST(cell AS VARCHAR) AS "Journey_Pattern_ID"
FROM raw WHERE speed IS NOT NULL AND operator IS NOT NULL""",
    "overview_by_date_in_order": _q(
        f"""
SELECT aggregation_date, {r('avg(congestion_rate)')} AS congestion_rate,
    CAST(sum(trip_count) AS BIGINT) AS trip_count, {r(score('avg(congestion_rate)'))} AS congestion_score,
    row_number() OVER (ORDER BY aggregation_date) AS place
FROM route_hourly
WHERE {_OVERVIEW_WHERE} AND aggregation_date IS NOT NULL
GROUP BY aggregation_date"""
    ),
    "overview_by_hour_in_order": _q(
        f"""
SELECT "hour", {r('avg(congestion_rate)')} AS congestion_rate,
    CAST(sum(trip_count) AS BIGINT) AS trip_count, {r(score('avg(congestion_rate)'))} AS congestion_score,
    row_number() OVER (ORDER BY "hour") AS place
FROM route_hourly
WHERE {_OVERVIEW_WHERE} AND "hour" IS NOT NULL
GROUP BY "hour\""""
    ),
    "route_kpis_from_state": _q(
        f"""
SELECT {r('avg(avg_delay)')} AS avg_delay, max(max_delay) AS max_delay,
    CAST(sum(trip_count) AS BIGINT) AS total_trips, {r('avg(congestion_rate)')} AS congestion_rate
FROM route_hourly
WHERE {_ROUTE_WHERE}"""
    ),
    "route_top10_from_state": _q(
        f"""
SELECT "Journey_Pattern_ID", {r('avg(avg_delay)')} AS avg_delay
FROM route_hourly
WHERE {_ROUTE_WHERE} AND "Journey_Pattern_ID" IS NOT NULL
GROUP BY "Journey_Pattern_ID"
ORDER BY avg(avg_delay) DESC, "Journey_Pattern_ID" ASC
LIMIT 10"""
    ),
    "band_kpis_empty": _band_kpis((7, 9), (24, 24)),
    "refresh_summary": _q(
        f"""
SELECT {_ITEM_COLS}
FROM {_items('2024-02-01T00:00:00')} AS items WHERE {_VALID}"""
    ),
    "summary_load_report_by_grain": _q(
        f"""
, items AS (
    SELECT 'daily' AS grain, "Journey_Pattern_ID" AS route, "Operatorname" AS operator, "date", 0 AS "hour"
    FROM derived GROUP BY ALL
    UNION ALL
    SELECT 'hourly', "Journey_Pattern_ID", "Operatorname", "date", "hour" FROM derived GROUP BY ALL
)
SELECT grain, count(*) FILTER (WHERE route IS NOT NULL AND "date" IS NOT NULL AND "hour" IS NOT NULL) AS success,
    count(*) FILTER (WHERE NOT (route IS NOT NULL AND "date" IS NOT NULL AND "hour" IS NOT NULL)) AS failed,
    count(*) AS total
FROM items GROUP BY grain"""
    ),
}

ORACLE_SQL |= {
    "summary_rejects": _q(
        f"""
SELECT {_ITEM_COLS}, CASE WHEN grain = 0 THEN 'daily' ELSE 'hourly' END AS grain,
    concat_ws(',', CASE WHEN route_id IS NULL THEN 'route_id missing' END,
        CASE WHEN time_bucket IS NULL THEN 'time_bucket missing' END,
        CASE WHEN operator IS NULL THEN 'operator missing' END) AS reason
FROM (SELECT *, CASE WHEN length(time_bucket) = 10 THEN 0 ELSE 1 END AS grain FROM {_items('2024-02-01T00:00:00')} AS i) AS items
WHERE NOT ({_VALID})"""
    ),
    "csv_rejected_rows": """
WITH raw AS (
    SELECT event_id % 11 = 0 AS speed, event_id % 13 = 0 AS operator, event_id % 17 = 0 AS longitude FROM events
)
SELECT concat_ws(', ', CASE WHEN longitude THEN 'Longitude missing' END, CASE WHEN speed THEN 'Speed unreadable' END,
        CASE WHEN operator THEN 'Operatorname missing' END) AS reason,
    count(*) AS n_rows, count(*) FILTER (WHERE speed) AS n_records
FROM raw WHERE speed OR operator OR longitude GROUP BY ALL""",
}

# Queries that reach the same rows by another way: written tables read back,
# CSV text, roll-ups of shared state, widget values.
ORACLE_SQL |= {
    name: ORACLE_SQL[same]
    for name, same in {
        "csv_route_hourly": "route_delay_by_hour",
        "mounted_route_hourly": "route_delay_by_hour",
        "mounted_summary": "refresh_summary",
        "summary_versions": "summary_upsert",
        "build_route_hourly": "route_delay_by_hour",
        "build_route_daily": "route_delay_daily",
        "build_stop_hourly": "stop_congestion_hourly",
        "overview_kpis_from_cells": "overview_kpis",
        "overview_by_date_from_cells": "overview_by_date",
        "overview_by_hour_from_cells": "overview_by_hour",
        "route_delay_by_date_from_state": "route_delay_by_date",
        "route_delay_by_hour_from_state": "route_delay_by_hour_of_day",
        "band_kpis_from_state": "band_kpis",
        "band_route_scores_from_state": "band_route_scores",
        "overview_kpis_from_selection": "overview_kpis",
    }.items()
}
