"""Batch pipelines (PIPE-1 build, PIPE-2 refresh) and their command line.

PIPE-1 reads the raw readings **once**: the scan, the per-row derivation
and the only shuffle of raw data all run in one job that writes the
hourly cell base (see :mod:`probelens.operators.aggregate`), rebalanced
on the date. The three curated tables are then built from the written base,
which also cuts the lineage: a lost executor costs a re-read of the base,
never of the raw input. The hourly route and stop tables are one-to-one
projections of the base and are written without a shuffle; only the daily
roll-up aggregates. The caller owns the session (D3); nothing here stops
it.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import logging
import sys
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JError
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from probelens import config as C
from probelens.functions.derive import derive_readings
from probelens.operators import aggregate as A
from probelens.operators import summary as S
from probelens.plans.journal import Journal, input_fingerprint
from probelens.sources import csv_ingest as I
from probelens.sources import tables as TB
from probelens.sources.events import events_path, read_event_readings, required_columns

log = logging.getLogger("probelens")


def clean_readings(raw: DataFrame) -> DataFrame:
    """VAL-3 then PRJ-1 ... PRJ-9: the readings every aggregate starts from."""
    return derive_readings(I.drop_incomplete(raw, required_columns(raw)))


def _observed(obs: Observation) -> dict | None:
    """An observation's metrics, or None where no executed stage reported any
    (adaptive execution drops a stage whose input turned out empty)."""
    try:
        return dict(obs.get)
    except Py4JError:
        return None


TABLES = (C.ROUTE_HOURLY, C.ROUTE_DAILY, C.STOP_HOURLY)
#: Rows that VAL-3 dropped, with file and reason (optional stage of a CSV build).
REJECTED_ROWS = "_rejected_rows"


def build_curated(spark: SparkSession, raw: I.RawInput | DataFrame | Callable[[], I.RawInput], out_root: str, fingerprint: str | None = None) -> dict:
    """PIPE-1: raw readings -> three curated tables under ``out_root``.

    Nothing that exists is overwritten, so a build that fails leaves the
    caller's present version as it was, and the caller switches to the new root
    once the report is there. With the input's ``fingerprint`` a build that
    failed is resumed by running it again (see :mod:`probelens.plans.journal`);
    ``raw`` may be a function then, called only where the base is still missing.

    Jobs: one over the raw input (scan, derive, aggregate, write the base,
    with the input quality observed on the way), a count over the written
    base, then the three table writes over the small base, submitted together
    so that their few tasks share the executors.

    The report's ``cleaned_rows`` and ``hourly_groups`` are counted in the
    written base and exact. ``raw_rows`` and ``null_counts`` are observed while
    the raw rows pass by: a stage that is run again after an executor loss may
    count its rows twice, and they are None where nothing was observed.
    """
    journal = Journal(spark, out_root, fingerprint)
    resumed = [n for n in (C.HOURLY_BASE, *TABLES) if journal.done(n) is not None]

    def write_base(folder: str) -> dict:
        found = raw() if callable(raw) else raw
        observed = found if isinstance(found, I.RawInput) else I.observe_quality(found)
        with I.header_errors():
            TB.write_base(A.hourly_cell_base(clean_readings(observed.df)), folder)
        rows = TB.read_base(spark, folder).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups")).first()
        if not rows["n"]:
            raise I.DataValidationError("no readings left after dropping rows with missing required values")
        return {"quality": _observed(observed.quality), "cleaned_rows": int(rows["n"]), "hourly_groups": int(rows["groups"])}

    facts = journal.run(C.HOURLY_BASE, write_base)
    base, quality = TB.read_base(spark, out_root), facts["quality"]

    # (builder, one row per base row): projections of a date-rebalanced base
    # are written map-only; the daily roll-up aggregates, so it shuffles
    laid_out = TB.adaptive(base)
    builders = {
        C.ROUTE_HOURLY: (A.route_delay_by_hour, laid_out),
        C.ROUTE_DAILY: (A.route_delay_daily, False),
        C.STOP_HOURLY: (A.stop_congestion_hourly, laid_out),
    }

    def write_table(name: str) -> str:
        build, ready = builders[name]
        journal.run(name, lambda folder: {"path": TB.write_curated(TB.conform(build(base), name), folder, name, ready) and name})
        return TB.table_path(out_root, name)

    with ThreadPoolExecutor(max_workers=len(builders)) as pool:
        # The writes belong to the caller's job group and scheduler pool.
        futures = {name: pool.submit(inheritable_thread_target(spark)(write_table), name) for name in builders}
        paths = {name: f.result() for name, f in futures.items()}
    return {
        "paths": paths,
        "base_path": TB.table_path(out_root, C.HOURLY_BASE),
        "raw_rows": int(quality["rows"]) if quality else None,
        "cleaned_rows": facts["cleaned_rows"],
        "hourly_groups": facts["hourly_groups"],
        "null_counts": {k[5:]: int(v) for k, v in quality.items() if k.startswith("null_")} if quality else None,
        "resumed": resumed,
    }


def build_from_csv(spark: SparkSession, raw_path: str | list[str], out_root: str, check_all_columns: bool = False, keep_rejected: bool = False) -> dict:
    """PIPE-1 over raw CSV files (SRC-1/SRC-2 with VAL-1 ... VAL-3).

    ``keep_rejected`` also writes the rows that VAL-3 drops, with file and
    reason, at the price of a second scan of the required columns.
    """
    known = input_fingerprint(spark, raw_path, check_all_columns=check_all_columns)
    out = build_curated(spark, lambda: I.load_probe_csv(spark, raw_path, check_all_columns), out_root, known)
    if keep_rejected:
        journal = Journal(spark, out_root, known)
        journal.run(REJECTED_ROWS, lambda folder: I.rejected_rows(spark, raw_path).write.parquet(TB.table_path(folder, REJECTED_ROWS)))
        out["rejected_path"] = TB.table_path(out_root, REJECTED_ROWS)
        out["rejected_rows"] = spark.read.parquet(out["rejected_path"]).count()
    return out


def build_from_events(spark: SparkSession, sf_dir: str, out_root: str) -> dict:
    """PIPE-1 over the ``events`` table, mapped to readings."""
    # An empty table surfaces as "no readings left" after the one raw job.
    known = input_fingerprint(spark, events_path(sf_dir))
    return build_curated(spark, read_event_readings(spark, sf_dir), out_root, known)


def utc_stamp() -> str:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat()


def load_summary(spark: SparkSession, curated_root: str, summary_root: str, updated_at: str | None = None) -> dict:
    """SNK-3 + SNK-4: upsert daily and hourly items into the summary at ``summary_root``.

    The first load creates it; ``summary_root`` has to lie apart from every
    input. Returns the load report, in total and per grain, and the version.
    """
    stamp = updated_at or utc_stamp()
    grains = {
        "daily": S.daily_items(TB.read_route_daily(spark, curated_root), stamp),
        "hourly": S.hourly_items(TB.read_route_hourly(spark, curated_root), stamp),
    }
    inputs = [TB.table_path(curated_root, n) for n in (C.ROUTE_DAILY, C.ROUTE_HOURLY)]
    report = S.write_upsert(spark, summary_root, grains, inputs)
    return {**report, "path": summary_root, "updated_at": stamp}


def refresh(
    spark: SparkSession,
    out_root: str,
    raw_path: str | list[str] | None = None,
    sf_dir: str | None = None,
    summary_root: str | None = None,
    updated_at: str | None = None,
) -> dict:
    """PIPE-2: full rebuild of the curated tables, then an optional summary load.

    Run again with the same root after a failure it resumes the build; a load is
    an upsert, so loading the same tables again changes nothing but the stamp.
    """
    if (raw_path is None) == (sf_dir is None):
        raise ValueError("give exactly one of raw_path (CSV) or sf_dir (events table)")
    etl = build_from_csv(spark, raw_path, out_root) if raw_path is not None else build_from_events(spark, sf_dir, out_root)
    out = {"success": True, "etl": etl}
    if summary_root:
        out["summary"] = load_summary(spark, out_root, summary_root, updated_at)
    return out


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="Rebuild curated probe tables and optionally load the summary table.")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--raw", help="raw CSV path or glob (local path or object-store URI)")
    src.add_argument("--events-dir", help="directory holding events.parquet")
    p.add_argument("--out", required=True, help="output root for curated tables: new, or one of a failed run over the same input")
    p.add_argument("--summary-root", help="folder of the summary that is loaded")
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName("probelens-refresh").getOrCreate()
    try:
        report = refresh(
            spark,
            args.out,
            raw_path=args.raw,
            sf_dir=args.events_dir,
            summary_root=args.summary_root,
        )
    except Exception as exc:  # report and exit non-zero, as a batch job should
        log.error("refresh failed: %s", exc)
        print(json.dumps({"success": False, "error": str(exc)}))
        return 1
    print(json.dumps(report, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
