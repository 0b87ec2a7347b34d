"""Plan shapes: what Catalyst must produce for the registered queries."""

from __future__ import annotations

import re

import pytest
from conftest import SF001
from fixtures import plan_text

from probelens.operators import aggregate as A
from probelens.plans import catalog
from probelens.plans.pipeline import clean_readings
from probelens.sources.events import read_event_readings

QUERIES = catalog.QUERIES

FORBIDDEN = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "FlatMapGroupsInPandas",
    "MapInPandas",
    "PythonUDF",
)


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_text(q(spark, SF001)) for name, q in QUERIES.items()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairs_no_python(plans, name):
    plan = plans[name]
    for node in FORBIDDEN:
        assert node not in plan, f"{name} plans {node}"


# Its rows are the counts that a refresh reports; the jobs behind it are those of other queries.
@pytest.mark.parametrize("name", sorted(QUERIES.keys() - {"summary_load_report_by_grain"}))
def test_events_scan_is_pruned(plans, name):
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", plans[name])
    assert schemas
    for s in schemas:
        assert "props" not in s
        assert "event_id" not in s or name == "text_time_readings"  # its rule is on the id
        assert "RSRP" not in s  # radio columns of CSV text are not converted


def test_raw_job_has_one_shuffle(spark):
    base = A.hourly_cell_base(clean_readings(read_event_readings(spark, SF001)))
    plan = plan_text(base)
    assert len(re.findall(r"^\(\d+\) Exchange", plan, flags=re.M)) == 1
    assert "partial_sum" in plan  # map-side partial aggregation before the shuffle


@pytest.mark.parametrize("name", ["route_top10_delay", "stop_top_n", "route_detail_first100"])
def test_top_k_uses_take_ordered(plans, name):
    assert "TakeOrderedAndProject" in plans[name]


def test_band_comparison_has_no_join(plans):
    for name in ("band_route_scores", "band_route_comparison", "band_route_long"):
        assert "Join" not in plans[name]


def test_filters_reach_below_the_aggregation(plans):
    plan = plans["stop_top_n"]
    # the date range is rewritten onto the raw timestamp and pushed to the scan
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts", plan)


def _upsert_inputs(spark):
    from probelens.operators import summary as S

    old = S.upsert(None, catalog._items(spark, SF001, catalog.UPSERT_OLD_STAMP))
    new = catalog._items(spark, SF001, catalog.UPSERT_NEW_STAMP, since=catalog.UPSERT_PARTIAL_FROM)
    return old, new


def _tree(plan: str) -> str:
    return plan.split("\n\n")[0]


def test_upsert_write_is_one_shuffle_without_join(spark):
    from probelens.operators import summary as S

    old, new = _upsert_inputs(spark)
    tree = _tree(plan_text(S.upsert_layout(old, new)))
    assert "Join" not in tree
    # the only exchange above the union is the key partitioning; the window
    # and the in-file order share one sort
    above_union = tree.split("Union")[0]
    assert len(re.findall(r"Exchange \(", above_union)) == 1
    assert len(re.findall(r"\bSort \(", above_union)) == 1
    assert "Window" in above_union
    assert "hashpartitioning(bucket_date#" in plan_text(S.upsert_layout(old, new))


def test_upsert_reads_each_load_once(spark):
    from probelens.operators import summary as S

    old, new = _upsert_inputs(spark)
    tree = _tree(plan_text(S.upsert(old, new)))
    assert "Join" not in tree
    # two loads x two grains, each over a written base: no plan of a load goes back to the events
    assert len(re.findall(r"Scan parquet", tree)) == 4
    assert "events.parquet" not in plan_text(S.upsert(old, new))


def test_band_filters_are_pushed_to_the_curated_scan(spark, tmp_path):
    from probelens.operators import reports as R
    from probelens.plans.pipeline import build_from_events
    from probelens.sources import tables as TB

    root = str(tmp_path / "curated")
    build_from_events(spark, SF001, root)
    hourly = TB.read_route_hourly(spark, root)
    for df in (R.band_kpis(hourly), R.band_route_state(hourly), R.band_route_scores(hourly)):
        assert re.search(r"PushedFilters: \[[^\n]*GreaterThanOrEqual\(hour,7\)", plan_text(df))
