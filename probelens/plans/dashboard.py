"""The dashboard's four tabs as bundles of lazy report frames, and a
headless command line that delivers them whole: bounded frames are printed,
frames with a row per route are written.

Each function takes the curated frame(s) a tab reads and the common filter
state, and returns the named frames the tab shows (indicators, series,
tables), without any UI. Nothing runs until a frame is acted on; frames of
one tab share the same filtered scan plan.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from probelens import config as C
from probelens.operators import reports as R
from probelens.operators.filters import FilterSpec
from probelens.sources import tables as TB


def overview_tab(hourly: DataFrame, spec: FilterSpec) -> dict[str, DataFrame]:
    """Overview: headline indicators, series by date (with its detail table)
    and by hour, all roll-ups of the tab's hourly cells (one curated read
    when the cells are kept, see :func:`shared_frames_kept`)."""
    cells = R.hour_cells(hourly, spec, "overview")
    out = R.overview_from_cells(cells)
    return {
        "cells": cells,
        "kpis": out["kpis"],
        "by_date": out["by_date"],
        "by_date_table": R.overview_date_table(out["by_date"]),
        "by_hour": out["by_hour"],
    }


def route_tab(hourly: DataFrame, spec: FilterSpec) -> dict[str, DataFrame]:
    """Route delay: indicators, delay by date and by hour, top routes (all
    roll-ups of one grouping-sets aggregation), detail rows. Two curated
    reads when the state is kept: the aggregation and the detail's top-k."""
    state = R.route_tab_state(hourly, spec)
    return {
        "state": state,
        **R.route_from_state(state),
        "detail": R.route_detail(hourly, spec),
    }


def stop_tab(stop_hourly: DataFrame, spec: FilterSpec, top_n: int = C.TOP_N_DEFAULT) -> dict[str, DataFrame]:
    """Stop congestion top N: indicators over the top N, ranked table, scatter."""
    top = R.top_stops(stop_hourly, spec, top_n)
    return {
        "top": top,
        "kpis": R.top_stop_kpis(top),
        "table": R.top_stop_table(top),
        "scatter": R.stop_scatter(top),
    }


def band_tab(
    hourly: DataFrame,
    spec: FilterSpec,
    band_a: str = C.DEFAULT_BAND_A,
    band_b: str = C.DEFAULT_BAND_B,
    label_a: str = C.DEFAULT_LABEL_A,
    label_b: str = C.DEFAULT_LABEL_B,
) -> dict[str, DataFrame]:
    """Time-band A/B comparison: band indicators, per-route scores (wide,
    rounded table, and long form for a grouped chart), all roll-ups of the
    per-route band state (one curated read when the state is kept)."""
    state = R.band_route_state(hourly, spec, band_a, band_b)
    out = R.band_from_state(state)
    scores = out["route_scores"]
    return {
        "route_state": state,
        "kpis": out["kpis"],
        "route_scores": scores,
        "comparison_table": R.band_comparison_table(scores),
        "long": R.band_route_long(scores, label_a, label_b),
    }


def filter_choices(hourly: DataFrame) -> dict[str, DataFrame]:
    """Options of the filter bar that come from the data (D7)."""
    return {"routes": R.route_choices(hourly), "operators": R.operator_choices(hourly)}


# Frames that other frames of the same tab are derived from, with their bound:
# hourly cells (one row per hour of the range; for the route tab plus one
# row per route), the top N stops (N <= 50), per-route band state.
SHARED_FRAMES = {"overview": ("cells",), "route": ("state",), "stop": ("top",), "ab": ("route_state",)}
# Frames that only serve others: not part of what a request shows.
INTERNAL_FRAMES = ("cells", "state", "route_state")
# Frames with a row (or two) per route: written, as their size has no fixed bound.
# All others are bounded by the calendar, the top N or the number of operators.
PER_ROUTE_FRAMES = ("route_scores", "comparison_table", "long", "routes")


@contextmanager
def shared_frames_kept(frames: dict[str, DataFrame], tab: str):
    """Keep a tab's shared frames while its frames are acted on.

    Without this, every frame derived from the stop top-N (indicators,
    ranked table, scatter) re-runs the roll-up over the curated table, and
    the overview's indicators and series each re-read it.
    Persisted blocks lost with an executor are recomputed from lineage.
    """
    shared = [frames[k] for k in SHARED_FRAMES.get(tab, ()) if k in frames]
    for df in shared:
        df.persist()
    try:
        yield frames
    finally:
        for df in shared:
            df.unpersist()


def tab_frames(spark: SparkSession, curated_root: str, tab: str, spec: FilterSpec, **kw) -> dict[str, DataFrame]:
    """The frames of ``tab`` (overview, route, stop, ab, choices) over a curated root."""
    if tab == "stop":
        return stop_tab(TB.read_stop_hourly(spark, curated_root), spec, kw.get("top_n", C.TOP_N_DEFAULT))
    hourly = TB.read_route_hourly(spark, curated_root)
    if tab == "overview":
        return overview_tab(hourly, spec)
    if tab == "route":
        return route_tab(hourly, spec)
    if tab == "ab":
        return band_tab(hourly, spec, kw.get("band_a", C.DEFAULT_BAND_A), kw.get("band_b", C.DEFAULT_BAND_B))
    if tab == "choices":
        return filter_choices(hourly)
    raise ValueError(f"unknown tab {tab!r}")


def _says_nothing(rows: list[dict]) -> bool:
    """No row, or one row of indicators that are all missing: the filters matched nothing."""
    return not rows or len(rows) == 1 and all(v is None or k.endswith("_score") for k, v in rows[0].items())


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="Print one dashboard tab's tables from curated tables.")
    p.add_argument("--curated", required=True, help="curated output root")
    p.add_argument("--tab", required=True, choices=["overview", "route", "stop", "ab", "choices"])
    p.add_argument("--date-from", type=dt.date.fromisoformat, help="with --date-to; without both the dashboard default range applies")
    p.add_argument("--date-to", type=dt.date.fromisoformat)
    p.add_argument("--weekday", action="append", default=None, help="weekday name as offered by the dashboard")
    p.add_argument("--route", action="append", default=None)
    p.add_argument("--hour-band", action="append", default=None, help='e.g. "06-10"; repeatable')
    p.add_argument("--operator", default=None)
    p.add_argument("--top-n", type=int, default=C.TOP_N_DEFAULT)
    p.add_argument("--band-a", default=C.DEFAULT_BAND_A)
    p.add_argument("--band-b", default=C.DEFAULT_BAND_B)
    p.add_argument("--out", help="new folder for the frames with a row per route (tabs ab and choices)")
    args = p.parse_args(argv)

    if bool(args.date_from) != bool(args.date_to):
        p.error("give both --date-from and --date-to, or neither")
    if args.tab in ("ab", "choices") and not args.out:
        p.error(f"tab {args.tab} has frames with a row per route: give --out")
    try:
        spec = FilterSpec.from_selection(
            date_input=(args.date_from, args.date_to) if args.date_from else None,
            weekday_names=args.weekday,
            routes=args.route,
            hour_band_labels=args.hour_band,
            operator_choice=args.operator,
        )
    except ValueError as exc:
        p.error(str(exc))
    # Interactive use: report plans are rebuilt on every request, and call-site
    # capture for error messages costs two JVM calls per Column built.
    spark = (
        SparkSession.builder.appName("probelens-dashboard")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    frames = tab_frames(spark, args.curated, args.tab, spec, top_n=args.top_n, band_a=args.band_a, band_b=args.band_b)
    with shared_frames_kept(frames, args.tab):
        for name, df in frames.items():
            if name in INTERNAL_FRAMES:
                continue
            if name in PER_ROUTE_FRAMES:
                path = f"{args.out.rstrip('/')}/{name}"
                df.write.parquet(path)
                print(json.dumps({"frame": name, "path": path}, ensure_ascii=False))
                continue
            rows = [r.asDict() for r in df.collect()]
            print(json.dumps({"frame": name, "rows": rows, "empty": _says_nothing(rows)}, default=str, ensure_ascii=False))
    return 0


if __name__ == "__main__":
    sys.exit(main())
