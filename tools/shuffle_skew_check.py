"""Measure the raw aggregation's shuffle with and without a hot cell.

Reproduces the table in README.md ("Hot keys"): the ``events`` table of a
scale-factor directory is split into 16 map tasks (as many input splits
would give at scale) and aggregated to the hourly cell base twice, once as
is and once with 40 % of the readings (``event_id % 5 < 2``) moved onto one
cell. Stage metrics come from Spark's event log, written to a fresh scratch
folder (a local measurement; the Spark UI stays off).

    python tools/shuffle_skew_check.py [/root/testdata/sf0.1]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from probelens.operators.aggregate import hourly_cell_base  # noqa: E402
from probelens.plans.pipeline import clean_readings  # noqa: E402
from probelens.sources.events import EVENTS_SCHEMA, events_path, readings_from_events  # noqa: E402

MAP_TASKS = 16
HOT_CELL_USER = 7  # user_id % 25 == 7: cell 7


def _events(fh_path: str):
    if fh_path.endswith(".zstd"):
        import zstandard

        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(fh_path, "rb")), encoding="utf-8")
    return open(fh_path, encoding="utf-8")


def stage_metrics(log_dir: str) -> list[dict]:
    """Per stage of each described job: tasks, shuffle records written and read."""
    job_of, stages = {}, {}
    for path in sorted(glob.glob(f"{log_dir}/**/events_*", recursive=True)):
        for line in _events(path):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                desc = e.get("Properties", {}).get("spark.job.description", "")
                job_of.update({s: desc for s in e["Stage IDs"]})
            elif e["Event"] == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                st = stages.setdefault(e["Stage ID"], {"tasks": 0, "written": 0, "read": 0, "max_read": 0})
                read = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                st["tasks"] += 1
                st["written"] += m.get("Shuffle Write Metrics", {}).get("Shuffle Records Written", 0)
                st["read"] += read
                st["max_read"] = max(st["max_read"], read)
    return [{"job": job_of.get(s, ""), "stage": s, **v} for s, v in sorted(stages.items()) if job_of.get(s)]


def main(sf_dir: str = "/root/testdata/sf0.1") -> None:
    scratch = tempfile.mkdtemp(prefix="probelens-skew-")
    log_dir = os.path.join(scratch, "eventlog")
    os.makedirs(log_dir)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    schema = T.StructType([*EVENTS_SCHEMA.fields, T.StructField("event_id", T.LongType())])
    ev = spark.read.schema(schema).parquet(events_path(sf_dir)).repartition(MAP_TASKS)
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 5 < 2, F.lit(HOT_CELL_USER)).otherwise(F.col("user_id")))
    for label, src in (("uniform", ev), ("hot", hot)):
        readings = clean_readings(readings_from_events(src.drop("event_id")))
        share = readings.where(F.col("CellID") == HOT_CELL_USER).count() / readings.count()
        spark.sparkContext.setJobDescription(f"base {label}")
        hourly_cell_base(readings).write.mode("overwrite").parquet(os.path.join(scratch, label))
        spark.sparkContext.setJobDescription(None)
        print(json.dumps({"input": label, "share_of_cell_7": round(share, 3)}))
    spark.stop()
    for row in stage_metrics(log_dir):
        print(json.dumps(row))


if __name__ == "__main__":
    main(*sys.argv[1:])
