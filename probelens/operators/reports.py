"""Dashboard report queries over curated tables (AGG-4 ... AGG-14, JOIN-1,
JOIN-2, SET-1, TOP-1, TOP-2, WIN-1, SRT-1, SRT-2, LIM-1, PRJ-15 ... PRJ-17).

Every report is one lazy plan: curated scan -> filter -> aggregate ->
(sort | top-k). Means are **unweighted means of the hourly group values**,
the source application's definition. Grouping by a key drops null keys
(as pandas ``groupby`` does, N3); global indicators keep every row.
Ties in a top-k are broken by the key, ascending, so results are
reproducible.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from probelens import config as C
from probelens.functions.derive import congestion_score
from probelens.operators.filters import FilterSpec, parse_band

ROUTE = "Journey_Pattern_ID"
STOP = "Stop_ID"


def _filtered(df: DataFrame, spec: FilterSpec | None, view: str) -> DataFrame:
    return df if spec is None else spec.apply(df, view)


def _by_key(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull())


def _calendar_series(df: DataFrame, key: str) -> DataFrame:
    """Order a per-date or per-hour series by its key.

    Such a series has at most one row per calendar day (or per hour of
    day) in the filter range, a bound set by the calendar, not by the data.
    The final aggregation still runs over all shuffle partitions; only its
    output (at most that many rows) is moved to one partition and sorted
    there, which saves the sampling job a global ``orderBy`` runs to plan
    its ranges. (``coalesce(1)`` would instead pull the final aggregation
    itself, with one partial row per map task and key, into one task.)
    """
    return df.repartition(1).sortWithinPartitions(key)


# ---------------------------------------------------------------------------
# One read per tab: hourly cells (overview and route tabs)
# ---------------------------------------------------------------------------

# An aggregate mean of a column of hourly rows: ``F.avg`` over the rows
# themselves, or :func:`cell_mean` over :func:`hour_cells`.
Mean = Callable[[str], Column]

# Hourly columns whose means the overview and route tabs report.
_CELL_MEANS = ("congestion_rate", "avg_delay", "avg_speed")


def hour_cells(hourly: DataFrame, spec: FilterSpec | None = None, view: str = "overview") -> DataFrame:
    """The filtered hourly rows reduced to one row per (date, hour).

    Each cell holds mergeable state: the sum and count of each hourly value
    averaged by a tab, the max delay and the trips. A tab's indicators and
    its date and hour series are all roll-ups of the cells, so a tab that
    keeps them for one request (see ``plans.dashboard``) reads the curated
    table once instead of once per frame. Cells are bounded by the calendar
    (one per hour of the filter range, plus null-key cells), not by routes.
    """
    return _filtered(hourly, spec, view).groupBy("aggregation_date", "hour").agg(*_cell_state())


def _cell_state() -> list[Column]:
    state = []
    for c in _CELL_MEANS:
        state += [F.sum(c).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n")]
    return [*state, F.max("max_delay").alias("max_delay"), F.sum("trip_count").alias("trip_count")]


def cell_mean(column: str) -> Column:
    """Mean of an hourly column over cells: summed values over summed counts,
    which is the mean over the underlying rows (null when there are none)."""
    return F.try_divide(F.sum(f"{column}_sum"), F.sum(f"{column}_n"))


def overview_from_cells(cells: DataFrame) -> dict[str, DataFrame]:
    """AGG-4, AGG-5, AGG-6 as roll-ups of :func:`hour_cells` (overview view)."""
    return {
        "kpis": _overview_kpis(cells, cell_mean),
        "by_date": _overview_series(cells, "aggregation_date", cell_mean),
        "by_hour": _overview_series(cells, "hour", cell_mean),
    }


def route_from_cells(cells: DataFrame) -> dict[str, DataFrame]:
    """AGG-7, AGG-8, AGG-9 as roll-ups of :func:`hour_cells` (route view)."""
    return {
        "kpis": _route_kpis(cells, cell_mean),
        "delay_by_date": _delay_series(cells, "aggregation_date", cell_mean),
        "delay_by_hour": _delay_series(cells, "hour", cell_mean),
    }


# grouping_id() of route_tab_state's sets (bits: aggregation_date, hour, route)
_CELLS_SET, _ROUTES_SET = 1, 6


def route_tab_state(hourly: DataFrame, spec: FilterSpec | None = None) -> DataFrame:
    """The route view's hourly cells and per-route state in one aggregation.

    ``GROUPING SETS ((aggregation_date, hour), (route))`` over the filtered
    rows: the first set is :func:`hour_cells`, the second the same state per
    route (the null route a group of its own), told apart by ``_set``. The
    route tab's indicators, series and top routes all roll up from it.
    """
    df = _filtered(hourly, spec, "route")
    keys = ["aggregation_date", "hour", ROUTE]
    sets = [["aggregation_date", "hour"], [ROUTE]]
    return df.groupingSets(sets, *keys).agg(*_cell_state(), F.grouping_id().alias("_set"))


def route_from_state(state: DataFrame, n: int = C.TOP_ROUTES) -> dict[str, DataFrame]:
    """AGG-7 ... AGG-10 and TOP-1 as roll-ups of :func:`route_tab_state`."""
    cells = state.where(F.col("_set") == _CELLS_SET).drop(ROUTE, "_set")
    routes = _by_key(state.where(F.col("_set") == _ROUTES_SET), ROUTE)
    mean_delay = routes.select(ROUTE, F.try_divide(F.col("avg_delay_sum"), F.col("avg_delay_n")).alias("avg_delay"))
    top = mean_delay.orderBy(F.desc("avg_delay"), F.asc(ROUTE)).limit(n)
    return {**route_from_cells(cells), "top_routes": top}


# ---------------------------------------------------------------------------
# Overview tab (route_delay_by_hour)
# ---------------------------------------------------------------------------


def overview_kpis(hourly: DataFrame, spec: FilterSpec | None = None) -> DataFrame:
    """AGG-4: one row of headline indicators.

    ``stop_slow_ratio`` equals the mean rate (the source defines it so);
    ``avg_speed`` is the mean of the hourly average speeds (D6).
    """
    return _overview_kpis(_filtered(hourly, spec, "overview"), F.avg)


def _overview_kpis(df: DataFrame, mean: Mean) -> DataFrame:
    rate = mean("congestion_rate")
    return df.agg(
        rate.alias("avg_congestion_rate"),
        congestion_score(rate).alias("congestion_score"),
        rate.alias("stop_slow_ratio"),
        F.sum("trip_count").alias("total_samples"),
        mean("avg_speed").alias("avg_speed"),
    )


def _overview_series(df: DataFrame, key: str, mean: Mean) -> DataFrame:
    return (
        _by_key(df, key)
        .groupBy(key)
        .agg(mean("congestion_rate").alias("congestion_rate"), F.sum("trip_count").alias("trip_count"))
        .withColumn("congestion_score", congestion_score("congestion_rate"))
        .transform(lambda d: _calendar_series(d, key))
    )


def overview_by_date(hourly: DataFrame, spec: FilterSpec | None = None) -> DataFrame:
    """AGG-5 + SRT-1: mean rate, summed trips and score per date, by date."""
    return _overview_series(_filtered(hourly, spec, "overview"), "aggregation_date", F.avg)


def overview_by_hour(hourly: DataFrame, spec: FilterSpec | None = None) -> DataFrame:
    """AGG-6 + SRT-2: mean rate, summed trips and score per hour, by hour."""
    return _overview_series(_filtered(hourly, spec, "overview"), "hour", F.avg)


def overview_date_table(series: DataFrame) -> DataFrame:
    """PRJ-16: the per-date detail table of the overview, rounded to 2."""
    return series.select(
        "aggregation_date",
        F.round("congestion_score", 2).alias("congestion_score"),
        F.round("congestion_rate", 2).alias("congestion_rate"),
        "trip_count",
    )


# ---------------------------------------------------------------------------
# Filter-bar choices (D7)
# ---------------------------------------------------------------------------


def route_choices(hourly: DataFrame) -> DataFrame:
    """The routes a user can pick (the source app never filled this list).

    A distinct over the curated table (partial aggregation map-side), then a
    distributed sort: the number of routes grows with the network, so it is
    not funnelled through one task.
    """
    return _sorted_distinct(hourly, ROUTE)


def operator_choices(hourly: DataFrame) -> DataFrame:
    """The operators a user can pick (the source app hard-coded A and B)."""
    return _sorted_distinct(hourly, "Operatorname")


def _sorted_distinct(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).select(key).distinct().orderBy(key)


# ---------------------------------------------------------------------------
# Route tab (route_delay_by_hour)
# ---------------------------------------------------------------------------


def route_kpis(hourly: DataFrame, spec: FilterSpec | None = None) -> DataFrame:
    """AGG-7: mean delay, max delay, total trips, mean rate."""
    return _route_kpis(_filtered(hourly, spec, "route"), F.avg)


def _route_kpis(df: DataFrame, mean: Mean) -> DataFrame:
    return df.agg(
        mean("avg_delay").alias("avg_delay"),
        F.max("max_delay").alias("max_delay"),
        F.sum("trip_count").alias("total_trips"),
        mean("congestion_rate").alias("congestion_rate"),
    )


def _delay_series(df: DataFrame, key: str, mean: Mean) -> DataFrame:
    return _calendar_series(_by_key(df, key).groupBy(key).agg(mean("avg_delay").alias("avg_delay")), key)


def route_delay_by_date(hourly: DataFrame, spec: FilterSpec | None = None) -> DataFrame:
    """AGG-8 + SRT-1: mean delay per date, by date."""
    return _delay_series(_filtered(hourly, spec, "route"), "aggregation_date", F.avg)


def route_delay_by_hour_of_day(hourly: DataFrame, spec: FilterSpec | None = None) -> DataFrame:
    """AGG-9 + SRT-2: mean delay per hour of day, by hour."""
    return _delay_series(_filtered(hourly, spec, "route"), "hour", F.avg)


def route_mean_delay(hourly: DataFrame, spec: FilterSpec | None = None) -> DataFrame:
    """AGG-10: mean delay per route."""
    df = _by_key(_filtered(hourly, spec, "route"), ROUTE)
    return df.groupBy(ROUTE).agg(F.avg("avg_delay").alias("avg_delay"))


def top_routes_by_delay(hourly: DataFrame, spec: FilterSpec | None = None, n: int = C.TOP_ROUTES) -> DataFrame:
    """TOP-1: the ``n`` routes with the highest mean delay.

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task
    keeps its own top ``n`` and only those reach the final merge.
    """
    return route_mean_delay(hourly, spec).orderBy(F.desc("avg_delay"), F.asc(ROUTE)).limit(n)


def route_detail(hourly: DataFrame, spec: FilterSpec | None = None, n: int = C.DETAIL_ROWS) -> DataFrame:
    """LIM-1: the first ``n`` filtered rows, ordered by the grouping key."""
    df = _filtered(hourly, spec, "route")
    order = [F.asc_nulls_last(c) for c in (ROUTE, "aggregation_date", "hour", "Operatorname")]
    return df.orderBy(*order).limit(n)


# ---------------------------------------------------------------------------
# Stop tab (stop_congestion_hourly)
# ---------------------------------------------------------------------------


def check_top_n(n: int) -> int:
    if not C.TOP_N_MIN <= int(n) <= C.TOP_N_MAX:
        raise ValueError(f"top N must be within {C.TOP_N_MIN}..{C.TOP_N_MAX}, got {n}")
    return int(n)


def stop_rollup(stop_hourly: DataFrame, spec: FilterSpec | None = None) -> DataFrame:
    """AGG-11: per stop, mean rate, summed counts, mean speed and delay."""
    df = _by_key(_filtered(stop_hourly, spec, "stop"), STOP)
    return df.groupBy(STOP).agg(
        F.avg("congestion_rate").alias("congestion_rate"),
        F.sum("congestion_count").alias("congestion_count"),
        F.sum("total_count").alias("total_count"),
        F.avg("avg_speed").alias("avg_speed"),
        F.avg("avg_delay").alias("avg_delay"),
    )


def top_stops(stop_hourly: DataFrame, spec: FilterSpec | None = None, n: int = C.TOP_N_DEFAULT) -> DataFrame:
    """TOP-2 + PRJ-11: the ``n`` stops (5..50) with the highest mean rate,
    with their congestion score."""
    n = check_top_n(n)
    top = stop_rollup(stop_hourly, spec).orderBy(F.desc("congestion_rate"), F.asc(STOP)).limit(n)
    return top.withColumn("congestion_score", congestion_score("congestion_rate"))


def top_stop_kpis(top: DataFrame) -> DataFrame:
    """AGG-12: indicators over the top-N rows only."""
    return top.agg(
        F.avg("congestion_rate").alias("avg_congestion_rate"),
        F.max("congestion_rate").alias("max_congestion_rate"),
        F.sum("congestion_count").alias("total_congestion_events"),
    )


def rank_top_stops(top: DataFrame) -> DataFrame:
    """WIN-1: rank 1..n over the top-N, numbered **after** the limit.

    The window sees at most ``n`` rows (one partition after the limit), so
    the unpartitioned window costs nothing; numbering before the limit
    would move every stop to one task.
    """
    w = Window.orderBy(F.desc("congestion_rate"), F.asc(STOP))
    return top.withColumn("Rank", F.row_number().over(w))


def top_stop_table(top: DataFrame) -> DataFrame:
    """PRJ-16: the ranked display table, rounded to 2 decimals."""
    ranked = rank_top_stops(top)
    return ranked.select(
        "Rank",
        STOP,
        F.round("avg_speed", 2).alias("avg_speed"),
        F.round("congestion_rate", 2).alias("congestion_rate"),
        F.round("congestion_score", 2).alias("congestion_score"),
        F.col("total_count").alias("sample_count"),
    )


def stop_scatter(top: DataFrame) -> DataFrame:
    """PRJ-17: speed against rate per top-N stop, sized by sample count."""
    return top.select(STOP, "avg_speed", "congestion_rate", F.col("total_count").alias("size"))


# ---------------------------------------------------------------------------
# A/B time-band tab (route_delay_by_hour)
# ---------------------------------------------------------------------------


def _band(label_or_band) -> tuple[int, int]:
    return parse_band(label_or_band) if isinstance(label_or_band, str) else tuple(label_or_band)


def _in_band(band: tuple[int, int]) -> Column:
    return F.col("hour").between(band[0], band[1])


def _band_mean(band: tuple[int, int]) -> Column:
    """Mean rate over rows of one band; null when the band has no row."""
    return F.avg(F.when(_in_band(band), F.col("congestion_rate")))


def band_kpis(
    hourly: DataFrame,
    spec: FilterSpec | None = None,
    band_a=C.DEFAULT_BAND_A,
    band_b=C.DEFAULT_BAND_B,
) -> DataFrame:
    """AGG-13: mean rate, score and speed for band A and band B, and B-A.

    Both bands come from one pass with conditional averages, so a reading
    hour in two overlapping bands (06-10 and 07-09) counts in both. Only the
    bands' hours are read. A band without a row has null measures, score and
    delta.
    """
    a, b = _band(band_a), _band(band_b)
    df = _filtered(hourly, spec, "ab").where(_in_band(a) | _in_band(b))
    agg = df.agg(
        _band_mean(a).alias("congestion_rate_a"),
        _band_mean(b).alias("congestion_rate_b"),
        F.avg(F.when(_in_band(a), F.col("avg_speed"))).alias("avg_speed_a"),
        F.avg(F.when(_in_band(b), F.col("avg_speed"))).alias("avg_speed_b"),
    )
    return _band_kpi_frame(agg)


def _band_score(rate: str) -> Column:
    """A band without a row has no score: null, not the 0 of a band without congestion."""
    return F.when(F.col(rate).isNotNull(), congestion_score(rate))


def _band_kpi_frame(agg: DataFrame) -> DataFrame:
    a, b = _band_score("congestion_rate_a"), _band_score("congestion_rate_b")
    return agg.select(
        "congestion_rate_a",
        a.alias("congestion_score_a"),
        "avg_speed_a",
        "congestion_rate_b",
        b.alias("congestion_score_b"),
        "avg_speed_b",
        (b - a).alias("score_delta"),
    )


def band_route_scores(
    hourly: DataFrame,
    spec: FilterSpec | None = None,
    band_a=C.DEFAULT_BAND_A,
    band_b=C.DEFAULT_BAND_B,
) -> DataFrame:
    """AGG-14 + JOIN-1 + JOIN-2: per route, mean rate and score in each band,
    for routes present in **both** bands.

    The source computes two grouped frames and inner-joins them on the
    route after intersecting their keys. Here one aggregation with two
    conditional means gives both sides per route in a single shuffle;
    keeping rows where both sides are non-null is exactly the inner join
    (and the key intersection), with no join shuffle at all.
    """
    a, b = _band(band_a), _band(band_b)
    df = _by_key(_filtered(hourly, spec, "ab"), ROUTE).where(_in_band(a) | _in_band(b))
    per_route = df.groupBy(ROUTE).agg(
        _band_mean(a).alias("congestion_rate_a"),
        _band_mean(b).alias("congestion_rate_b"),
    )
    return _both_bands(per_route)


def _both_bands(per_route: DataFrame) -> DataFrame:
    both = per_route.where(F.col("congestion_rate_a").isNotNull() & F.col("congestion_rate_b").isNotNull())
    return both.select(
        ROUTE,
        "congestion_rate_a",
        congestion_score("congestion_rate_a").alias("congestion_score_a"),
        "congestion_rate_b",
        congestion_score("congestion_rate_b").alias("congestion_score_b"),
    )


def band_route_state(
    hourly: DataFrame,
    spec: FilterSpec | None = None,
    band_a=C.DEFAULT_BAND_A,
    band_b=C.DEFAULT_BAND_B,
) -> DataFrame:
    """Per route, the sums and counts of rate and speed in band A and in band B.

    The null route is a group of its own, so the band indicators (which
    count every row) and the per-route scores (which drop it) are both
    roll-ups of this one aggregation: an A/B tab that keeps it for one
    request reads the curated table once. One row per route.
    """
    a, b = _band(band_a), _band(band_b)
    state = []
    for tag, band in (("a", a), ("b", b)):
        for column, name in (("congestion_rate", "rate"), ("avg_speed", "speed")):
            v = F.when(_in_band(band), F.col(column))
            state += [F.sum(v).alias(f"{name}_{tag}_sum"), F.count(v).alias(f"{name}_{tag}_n")]
    return _filtered(hourly, spec, "ab").where(_in_band(a) | _in_band(b)).groupBy(ROUTE).agg(*state)


def band_from_state(state: DataFrame) -> dict[str, DataFrame]:
    """AGG-13 and AGG-14/JOIN-1/JOIN-2 as roll-ups of :func:`band_route_state`."""

    def mean(prefix: str, over_groups: bool) -> Column:
        s_, n_ = f"{prefix}_sum", f"{prefix}_n"
        if over_groups:
            return F.try_divide(F.sum(s_), F.sum(n_))
        return F.try_divide(F.col(s_), F.col(n_))

    kpis = state.agg(
        mean("rate_a", True).alias("congestion_rate_a"),
        mean("rate_b", True).alias("congestion_rate_b"),
        mean("speed_a", True).alias("avg_speed_a"),
        mean("speed_b", True).alias("avg_speed_b"),
    )
    per_route = _by_key(state, ROUTE).select(
        ROUTE,
        mean("rate_a", False).alias("congestion_rate_a"),
        mean("rate_b", False).alias("congestion_rate_b"),
    )
    return {"kpis": _band_kpi_frame(kpis), "route_scores": _both_bands(per_route)}


def band_comparison_table(scores: DataFrame) -> DataFrame:
    """PRJ-16: route with both scores, rounded to 2 decimals."""
    return scores.select(
        ROUTE,
        F.round("congestion_score_a", 2).alias("congestion_score_a"),
        F.round("congestion_score_b", 2).alias("congestion_score_b"),
    )


def band_route_long(
    scores: DataFrame,
    label_a: str = C.DEFAULT_LABEL_A,
    label_b: str = C.DEFAULT_LABEL_B,
) -> DataFrame:
    """SET-1 + PRJ-15: the band A rows and the band B rows as one long frame
    with a ``time_period`` label column, for a grouped chart.

    The union of the two row sets is produced by one generator over the
    wide per-route frame, so the aggregate is computed once.
    """
    a = F.struct(
        F.lit(label_a).alias("time_period"),
        F.col("congestion_rate_a").alias("congestion_rate"),
        F.col("congestion_score_a").alias("congestion_score"),
    )
    b = F.struct(
        F.lit(label_b).alias("time_period"),
        F.col("congestion_rate_b").alias("congestion_rate"),
        F.col("congestion_score_b").alias("congestion_score"),
    )
    return scores.select(ROUTE, F.inline(F.array(a, b)))
