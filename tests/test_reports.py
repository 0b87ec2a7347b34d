"""Reports against sums and sorts in plain Python over the curated rows.

The expected values are worked out row by row from the definition of each
indicator: a mean is a running sum over a count, a ranking a sort on
(value, key). No data-frame library takes part.
"""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

import pytest
from conftest import SF001
from fixtures import plan_text

from probelens.operators import reports as R
from probelens.operators.filters import FilterSpec
from probelens.plans import catalog

FIRST, LAST = dt.date(2024, 1, 1), dt.date(2024, 1, 31)
SPEC = FilterSpec(date_range=(FIRST, LAST), hour_bands=((0, 23),))


class Mean:
    """Arithmetic mean of the values it was given; None without any."""

    def __init__(self):
        self.total, self.n = 0.0, 0

    def add(self, value):
        if value is not None:
            self.total, self.n = self.total + value, self.n + 1

    @property
    def value(self):
        return self.total / self.n if self.n else None


def clamp(rate):
    return None if rate is None else max(0.0, min(rate, 100.0))


@pytest.fixture(scope="module")
def hourly(spark):
    return catalog.route_hourly(spark, SF001)


@pytest.fixture(scope="module")
def stops(spark):
    return catalog.stop_hourly(spark, SF001)


@pytest.fixture(scope="module")
def hours(hourly):
    """Rows of the hourly route table that SPEC selects."""
    return [r for r in hourly.collect() if r.aggregation_date and FIRST <= r.aggregation_date <= LAST]


@pytest.fixture(scope="module")
def stop_hours(stops):
    return [r for r in stops.collect() if r.aggregation_date and FIRST <= r.aggregation_date <= LAST]


def test_overview_indicators(hourly, hours):
    rate = Mean()
    samples = 0
    for r in hours:
        rate.add(r.congestion_rate)
        samples += r.trip_count
    got = R.overview_kpis(hourly, SPEC).first()
    assert got.avg_congestion_rate == pytest.approx(rate.value)
    assert got.congestion_score == pytest.approx(clamp(rate.value))
    assert got.total_samples == samples


def test_overview_series_by_date(hourly, hours):
    rate, trips = defaultdict(Mean), defaultdict(int)
    for r in hours:
        rate[r.aggregation_date].add(r.congestion_rate)
        trips[r.aggregation_date] += r.trip_count
    got = R.overview_by_date(hourly, SPEC).collect()
    assert [g.aggregation_date for g in got] == sorted(rate)
    for g in got:
        assert g.congestion_rate == pytest.approx(rate[g.aggregation_date].value)
        assert g.trip_count == trips[g.aggregation_date]


def test_top_routes(hourly, hours):
    delay = defaultdict(Mean)
    for r in hours:
        if r.Journey_Pattern_ID is not None:
            delay[r.Journey_Pattern_ID].add(r.avg_delay)
    ranked = sorted(delay, key=lambda route: (-delay[route].value, route))
    assert [g.Journey_Pattern_ID for g in R.top_routes_by_delay(hourly, SPEC).collect()] == ranked[:10]


def test_top_stops_and_their_indicators(stops, stop_hours):
    rate, events = defaultdict(Mean), defaultdict(int)
    for r in stop_hours:
        if r.Stop_ID is not None:
            rate[r.Stop_ID].add(r.congestion_rate)
            events[r.Stop_ID] += r.congestion_count
    best = sorted(rate, key=lambda stop: (-rate[stop].value, stop))[:5]
    top = R.top_stops(stops, SPEC, 5)
    assert [g.Stop_ID for g in top.collect()] == best
    kpis = R.top_stop_kpis(top).first()
    assert kpis.avg_congestion_rate == pytest.approx(sum(rate[s].value for s in best) / 5)
    assert kpis.max_congestion_rate == pytest.approx(rate[best[0]].value)
    assert kpis.total_congestion_events == sum(events[s] for s in best)


def test_rank_numbers_follow_order(stops):
    ranked = R.top_stop_table(R.top_stops(stops, SPEC, 5)).orderBy("Rank").collect()
    assert [r["Rank"] for r in ranked] == [1, 2, 3, 4, 5]
    rates = [r["congestion_rate"] for r in ranked]
    assert rates == sorted(rates, reverse=True)


def test_rank_after_limit_has_no_single_partition_exchange(stops):
    plan = plan_text(R.top_stop_table(R.top_stops(stops, SPEC, 10)))
    assert "TakeOrderedAndProject" in plan
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("n", [4, 51])
def test_top_n_bounds(stops, n):
    with pytest.raises(ValueError):
        R.top_stops(stops, SPEC, n)


@pytest.mark.parametrize("bands", [((7, 9), (17, 19)), ((6, 10), (7, 9))])
def test_band_comparison(hourly, bands):
    """One Mean per (band, route); a route counts if each of its two Means has seen a row."""
    overall = [Mean(), Mean()]
    by_route = defaultdict(lambda: (Mean(), Mean()))
    for r in hourly.collect():
        for k, (start, end) in enumerate(bands):
            if r.hour is not None and start <= r.hour <= end:
                overall[k].add(r.congestion_rate)
                by_route[r.Journey_Pattern_ID][k].add(r.congestion_rate)
    want = {route: (a.value, b.value) for route, (a, b) in by_route.items() if route is not None and a.n and b.n}
    got = {g.Journey_Pattern_ID: (g.congestion_rate_a, g.congestion_rate_b) for g in R.band_route_scores(hourly, None, *bands).collect()}
    assert got.keys() == want.keys()
    for route, pair in want.items():
        assert got[route] == pytest.approx(pair)
    k = R.band_kpis(hourly, None, *bands).first()
    a, b = (m.value for m in overall)
    assert (k.congestion_rate_a, k.congestion_rate_b) == pytest.approx((a, b))
    assert k.score_delta == pytest.approx(clamp(b) - clamp(a))


def test_empty_band_has_no_score(hourly):
    for frame in (R.band_kpis(hourly, None, "07-09", "24-24"), R.band_from_state(R.band_route_state(hourly, None, "07-09", "24-24"))["kpis"]):
        k = frame.first()
        assert k.congestion_score_a is not None
        assert k.congestion_rate_b is None and k.congestion_score_b is None and k.score_delta is None


def test_band_long_form_has_both_labels(hourly):
    scores = R.band_route_scores(hourly)
    long = R.band_route_long(scores, "am", "pm")
    assert long.count() == 2 * scores.count()
    assert {r[0] for r in long.select("time_period").distinct().collect()} == {"am", "pm"}


def test_route_detail_is_first_rows_by_key(hourly, hours):
    key = lambda r: (r.Journey_Pattern_ID, r.aggregation_date, r.hour, r.Operatorname)
    want = sorted(key(r) for r in hours if r.Journey_Pattern_ID is not None)[:7]
    assert [key(r) for r in R.route_detail(hourly, SPEC, 7).collect()] == want


def test_score_clamps_nulls_and_nan(spark):
    from pyspark.sql import functions as F

    from probelens.functions.derive import congestion_score

    df = spark.createDataFrame([(None,), (float("nan"),), (-3.0,), (150.0,), (42.5,)], "x double")
    got = [r[0] for r in df.select(congestion_score(F.col("x"))).collect()]
    assert got == [0.0, 0.0, 0.0, 100.0, 42.5]
