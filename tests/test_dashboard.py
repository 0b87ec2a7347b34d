"""Tab bundles over written curated tables, and the headless CLI."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from conftest import SF001

from probelens.operators.filters import FilterSpec
from probelens.plans.dashboard import main, tab_frames
from probelens.plans.pipeline import build_from_events

SPEC = FilterSpec(date_range=(dt.date(2024, 1, 1), dt.date(2024, 1, 31)), hour_bands=((0, 23),))


@pytest.fixture(scope="module")
def curated(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("dash"))
    build_from_events(spark, SF001, root)
    return root


@pytest.mark.parametrize(
    "tab,frames",
    [
        ("overview", {"cells", "kpis", "by_date", "by_date_table", "by_hour"}),
        ("route", {"state", "kpis", "delay_by_date", "delay_by_hour", "top_routes", "detail"}),
        ("stop", {"top", "kpis", "table", "scatter"}),
        ("ab", {"route_state", "kpis", "route_scores", "comparison_table", "long"}),
        ("choices", {"routes", "operators"}),
    ],
)
def test_tabs_run(spark, curated, tab, frames):
    got = tab_frames(spark, curated, tab, SPEC)
    assert set(got) == frames
    for df in got.values():
        df.collect()


def test_overview_tab_has_one_kpi_row_and_sorted_dates(spark, curated):
    got = tab_frames(spark, curated, "overview", SPEC)
    assert got["kpis"].count() == 1
    dates = [r[0] for r in got["by_date"].select("aggregation_date").collect()]
    assert dates == sorted(dates) and len(dates) == 30


def test_cli_prints_every_frame(spark, curated, capsys):
    code = main(["--curated", curated, "--tab", "stop", "--date-from", "2024-01-01", "--date-to", "2024-01-31", "--top-n", "5"])
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert code == 0 and [x["frame"] for x in lines] == ["top", "kpis", "table", "scatter"]
    assert len(lines[2]["rows"]) == 5


@pytest.mark.parametrize(
    "bad",
    [
        ["--weekday", "Monday"],
        ["--hour-band", "0610"],
        ["--hour-band", "10-06"],
        ["--date-from", "2024-01-01"],
        ["--date-to", "2024-01-01"],
    ],
)
def test_cli_refuses_what_it_cannot_apply(spark, curated, bad):
    with pytest.raises(SystemExit):
        main(["--curated", curated, "--tab", "stop", *bad])


def test_cli_needs_a_place_for_per_route_frames(spark, curated):
    with pytest.raises(SystemExit):
        main(["--curated", curated, "--tab", "ab"])


def test_default_date_range_is_the_dashboards(spark, curated, capsys):
    main(["--curated", curated, "--tab", "overview"])
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    by_date = [x for x in lines if x["frame"] == "by_date"][0]
    assert by_date["empty"] and [x for x in lines if x["frame"] == "kpis"][0]["empty"]
    assert by_date["rows"] == []  # 2017-11-30 ... 2018-01-27 holds none of the 2024 readings


@pytest.mark.parametrize(
    "tab,shared,derived",
    [
        ("stop", "top", ("kpis", "table", "scatter")),
        ("ab", "route_state", ("kpis", "route_scores", "comparison_table", "long")),
        ("overview", "cells", ("kpis", "by_date", "by_date_table", "by_hour")),
        ("route", "state", ("kpis", "delay_by_date", "delay_by_hour", "top_routes")),
    ],
)
def test_derived_frames_read_the_kept_shared_frame(spark, curated, tab, shared, derived):
    from fixtures import plan_text

    from probelens.plans.dashboard import shared_frames_kept

    plain = tab_frames(spark, curated, tab, SPEC)
    def rows(df):
        return sorted((r.asDict() for r in df.collect()), key=repr)

    expected = {name: rows(plain[name]) for name in derived}
    # a frame picks up cached data when first planned, so nothing of this set
    # is acted on before the shared frame is kept (as in the CLI)
    frames = tab_frames(spark, curated, tab, SPEC)
    with shared_frames_kept(frames, tab):
        assert frames[shared].storageLevel.useMemory
        for name in derived:
            assert "InMemoryTableScan" in plan_text(frames[name]), name
            assert rows(frames[name]) == expected[name]
    level = frames[shared].storageLevel
    assert not level.useMemory and not level.useDisk


DIRECT = {
    "overview": {"kpis": "overview_kpis", "by_date": "overview_by_date", "by_hour": "overview_by_hour"},
    "route": {
        "kpis": "route_kpis",
        "delay_by_date": "route_delay_by_date",
        "delay_by_hour": "route_delay_by_hour_of_day",
        "top_routes": "top_routes_by_delay",
    },
    "ab": {"kpis": "band_kpis", "route_scores": "band_route_scores"},
}
SPECS = [
    SPEC,
    FilterSpec(
        date_range=(dt.date(2024, 1, 3), dt.date(2024, 1, 27)),
        weekdays=(1, 2, 3, 4, 5),
        hour_bands=((6, 10), (16, 20)),
        operator="A",
    ),
    FilterSpec(date_range=(dt.date(2030, 1, 1), dt.date(2030, 1, 2))),  # no rows
]


@pytest.mark.parametrize("tab", sorted(DIRECT))
@pytest.mark.parametrize("spec", SPECS, ids=["month", "weekday-bands-op", "empty"])
def test_cell_rollups_equal_direct_reports(spark, curated, tab, spec):
    """Roll-ups of the hourly cells give the direct reports' rows (means of
    the hourly values, to 1e-9), including the one-row answer on no input."""
    from probelens.operators import reports as R
    from probelens.sources import tables as TB

    hourly = TB.read_route_hourly(spark, curated)
    frames = tab_frames(spark, curated, tab, spec)
    def key(r):  # series are ordered; per-route scores are not
        return repr([(k, v) for k, v in r.items() if not isinstance(v, float)])

    for name, fn in DIRECT[tab].items():
        got = sorted((r.asDict() for r in frames[name].collect()), key=key)
        exp = sorted((r.asDict() for r in getattr(R, fn)(hourly, spec).collect()), key=key)
        assert len(got) == len(exp), name
        for a, b in zip(got, exp):
            assert a.keys() == b.keys()
            for k in a:
                if isinstance(a[k], float) and isinstance(b[k], float):
                    assert abs(a[k] - b[k]) <= 1e-9 * max(1.0, abs(b[k])), (name, k)
                else:
                    assert a[k] == b[k], (name, k)


@pytest.mark.parametrize("tab", ["overview", "route", "stop", "ab", "choices"])
def test_cli_every_tab_delivers_its_frames_whole_and_releases_the_cache(spark, curated, capsys, tab, tmp_path):
    from probelens.plans.dashboard import INTERNAL_FRAMES

    out = str(tmp_path / "frames")
    code = main(["--curated", curated, "--tab", tab, "--date-from", "2024-01-01", "--date-to", "2024-01-31", "--out", out])
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    whole = tab_frames(spark, curated, tab, FilterSpec(date_range=SPEC.date_range))
    assert code == 0 and [x["frame"] for x in lines] == [n for n in whole if n not in INTERNAL_FRAMES]
    for x in lines:
        delivered = spark.read.parquet(x["path"]).count() if "path" in x else len(x["rows"])
        assert delivered == whole[x["frame"]].count() > 0
    # the kept frame was released: nothing of this request stays cached
    jvm_cache = spark._jsparkSession.sharedState().cacheManager()
    assert jvm_cache.isEmpty()
