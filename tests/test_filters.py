"""Filter state normalisation and the per-view predicate matrix."""

from __future__ import annotations

import datetime as dt

import pytest

from probelens import config as C
from probelens.operators.filters import (
    VIEW_PARTS,
    FilterSpec,
    hour_bands_from_labels,
    normalize_date_input,
    operator_from_choice,
    parse_band,
    weekday_numbers,
)

D = dt.date


def test_date_input_forms():
    assert normalize_date_input((D(2024, 1, 1), D(2024, 1, 5))) == (D(2024, 1, 1), D(2024, 1, 5))
    assert normalize_date_input(D(2024, 1, 3)) == (D(2024, 1, 3), D(2024, 1, 3))
    assert normalize_date_input(None) == C.DEFAULT_DATE_RANGE
    assert normalize_date_input(["2024-01-02", "2024-01-09"]) == (D(2024, 1, 2), D(2024, 1, 9))


def test_weekday_names():
    assert weekday_numbers(["월", "일"]) == (1, 7)
    assert weekday_numbers([C.ALL_CHOICE, "월"]) is None
    assert weekday_numbers([]) is None


def test_hour_bands_are_a_union_not_a_hull():
    assert hour_bands_from_labels(["00-06", "20-24"]) == ((0, 6), (20, 24))
    assert hour_bands_from_labels([C.ALL_CHOICE]) is None
    assert parse_band("07-09") == (7, 9)


def test_operator_choice():
    assert operator_from_choice(C.ALL_CHOICE) is None
    assert operator_from_choice("A") == "A"


def test_view_matrix():
    assert VIEW_PARTS["overview"] == {"date", "weekday", "hour", "operator"}
    assert VIEW_PARTS["ab"] == {"date", "weekday", "route", "operator"}
    assert "route" in VIEW_PARTS["route"] and "route" not in VIEW_PARTS["stop"]


@pytest.fixture(scope="module")
def rows(spark):
    data = [
        ("A_1", D(2024, 1, 1), 0, "A"),  # Monday
        ("A_1", D(2024, 1, 6), 12, "A"),  # Saturday
        ("B_2", D(2024, 1, 7), 21, "B"),  # Sunday
        ("B_2", D(2024, 1, 8), 7, "B"),  # Monday
        (None, D(2024, 1, 8), None, "B"),
    ]
    return spark.createDataFrame(data, "Journey_Pattern_ID string, aggregation_date date, hour int, Operatorname string")


def _keys(df):
    return sorted((r[0] or "", r[1].isoformat()) for r in df.select("Journey_Pattern_ID", "aggregation_date").collect())


def test_hour_bands_exclude_the_gap_and_nulls(rows):
    spec = FilterSpec(hour_bands=((0, 6), (20, 24)))
    assert _keys(spec.apply(rows, "overview")) == [("A_1", "2024-01-01"), ("B_2", "2024-01-07")]


def test_iso_weekday_filter(rows):
    spec = FilterSpec(weekdays=(6, 7))
    assert _keys(spec.apply(rows, "route")) == [("A_1", "2024-01-06"), ("B_2", "2024-01-07")]


def test_route_filter_only_where_the_view_applies_it(rows):
    spec = FilterSpec(routes=("A_1",))
    assert len(_keys(spec.apply(rows, "route"))) == 2
    assert len(_keys(spec.apply(rows, "overview"))) == 5


def test_hour_filter_not_applied_on_ab_view(rows):
    spec = FilterSpec(hour_bands=((0, 0),))
    assert rows.count() == spec.apply(rows, "ab").count()


def test_missing_column_skips_predicate(rows):
    spec = FilterSpec(routes=("A_1",), operator="A")
    no_route = rows.drop("Journey_Pattern_ID")
    assert spec.apply(no_route, "route").count() == 2


def test_date_range_inclusive(rows):
    spec = FilterSpec(date_range=(D(2024, 1, 6), D(2024, 1, 7)))
    assert len(_keys(spec.apply(rows, "stop"))) == 2


def test_from_selection():
    spec = FilterSpec.from_selection(
        date_input=D(2024, 1, 3), weekday_names=["토"], hour_band_labels=["06-10"], operator_choice=C.ALL_CHOICE
    )
    assert spec == FilterSpec(date_range=(D(2024, 1, 3), D(2024, 1, 3)), weekdays=(6,), hour_bands=((6, 10),))


# -- property test: the compiled predicate against a plain Python filter -----

from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_DAYS = [D(2024, 1, d) for d in range(1, 15)]
_ROUTES = ["A_1", "A_2", "B_1", None]
_OPS = ["A", "B"]
_ROWS = [
    (_ROUTES[i % 4], _DAYS[(i * 5) % 14] if i % 11 else None, (i * 7) % 25 if i % 13 else None, _OPS[i % 2])
    for i in range(120)
]

_specs = st.builds(
    FilterSpec,
    date_range=st.none()
    | st.tuples(st.sampled_from(_DAYS), st.sampled_from(_DAYS)).map(lambda t: (min(t), max(t))),
    weekdays=st.none() | st.lists(st.integers(1, 7), min_size=1, max_size=3).map(tuple),
    routes=st.lists(st.sampled_from(["A_1", "A_2", "B_1", "C_9"]), max_size=2).map(tuple),
    hour_bands=st.none()
    | st.lists(st.tuples(st.integers(0, 24), st.integers(0, 24)).map(lambda t: (min(t), max(t))), min_size=1, max_size=3).map(tuple),
    operator=st.none() | st.sampled_from(_OPS),
)


def _keep(spec: FilterSpec, view: str, row) -> bool:
    route, day, hour, op = row
    parts = VIEW_PARTS[view]
    if spec.date_range and "date" in parts:
        if day is None or not spec.date_range[0] <= day <= spec.date_range[1]:
            return False
    if spec.weekdays and "weekday" in parts:
        if day is None or day.isoweekday() not in spec.weekdays:
            return False
    if spec.routes and "route" in parts and route not in spec.routes:
        return False
    if spec.hour_bands and "hour" in parts:
        if hour is None or not any(a <= hour <= b for a, b in spec.hour_bands):
            return False
    if spec.operator is not None and "operator" in parts and op != spec.operator:
        return False
    return True


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(_ROWS, "Journey_Pattern_ID string, aggregation_date date, hour int, Operatorname string")


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(spec=_specs, view=st.sampled_from(sorted(VIEW_PARTS)))
def test_predicate_matches_python_filter(table, spec, view):
    got = sorted(map(repr, (tuple(r) for r in spec.apply(table, view).collect())))
    want = sorted(map(repr, (r for r in _ROWS if _keep(spec, view, r))))
    assert got == want
