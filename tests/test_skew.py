"""Skew: a date holding most rows is split over several writer tasks."""

from __future__ import annotations

import datetime as dt
import os

from conftest import SF01
from pyspark.sql import functions as F

from probelens import config as C
from probelens.plans import catalog
from probelens.sources import tables as TB

HOT = dt.date(2024, 1, 5)


def test_hot_date_is_split_into_several_files(spark, tmp_path):
    hourly = catalog.route_hourly(spark, SF01)
    # derived from the given table: move every hour before 20h onto one date
    skewed = hourly.withColumn(
        "aggregation_date", F.when(F.col("hour") < 20, F.lit(HOT)).otherwise(F.col("aggregation_date"))
    )
    total = skewed.count()
    hot_rows = skewed.where(F.col("aggregation_date") == F.lit(HOT)).count()
    assert hot_rows > total / 3

    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    old = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    try:
        root = str(tmp_path / "skewed")
        TB.write_curated(TB.conform(skewed, C.ROUTE_HOURLY), root, C.ROUTE_HOURLY)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

    hot_dir = os.path.join(TB.table_path(root, C.ROUTE_HOURLY), f"aggregation_date={HOT.isoformat()}")
    files = [f for f in os.listdir(hot_dir) if f.endswith(".parquet")]
    assert len(files) > 1
    back = TB.read_route_hourly(spark, root)
    assert back.count() == total
    assert back.where(F.col("aggregation_date") == F.lit(HOT)).count() == hot_rows


def test_hot_cell_keeps_whole_results(spark):
    """A cell holding ~40% of all readings: every reading is still counted,
    in exactly the groups a direct aggregation of the readings gives."""
    from probelens.operators import aggregate as A
    from probelens.plans.pipeline import clean_readings
    from probelens.sources.events import EVENTS_SCHEMA, events_path, readings_from_events
    from pyspark.sql import types as T

    schema = T.StructType([*EVENTS_SCHEMA.fields, T.StructField("event_id", T.LongType())])
    ev = spark.read.schema(schema).parquet(events_path(SF01)).repartition(16)
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 5 < 2, F.lit(7)).otherwise(F.col("user_id")))
    readings = clean_readings(readings_from_events(hot.drop("event_id")))
    n, hot_n = readings.count(), readings.where(F.col("CellID") == 7).count()
    assert hot_n > n / 3

    base = A.hourly_cell_base(readings)
    assert base.agg(F.sum("n")).first()[0] == n
    keys = ["CellID", "date", "hour", "Operatorname"]
    direct = readings.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("Delay").alias("delay_sum"))
    got = base.select(*keys, "n", "delay_sum")
    assert got.exceptAll(direct).count() == 0 and direct.exceptAll(got).count() == 0


def test_hot_date_in_the_base_spreads_over_the_map_only_hourly_table(spark, tmp_path):
    """The hourly tables inherit the base's date layout: a date holding most
    groups is split over several base files, hence several hourly files."""
    from probelens.operators import aggregate as A
    from probelens.plans.pipeline import clean_readings
    from probelens.sources.events import read_event_readings

    base = A.hourly_cell_base(clean_readings(read_event_readings(spark, SF01)))
    skewed = base.withColumn("date", F.when(F.col("hour") < 20, F.lit(HOT)).otherwise(F.col("date")))
    total = skewed.count()
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    old = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    root = str(tmp_path / "skewed_base")
    try:
        TB.write_base(skewed, root)
        TB.write_curated(TB.conform(A.route_delay_by_hour(TB.read_base(spark, root)), C.ROUTE_HOURLY), root, C.ROUTE_HOURLY, laid_out=True)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    hot_dir = os.path.join(TB.table_path(root, C.ROUTE_HOURLY), f"aggregation_date={HOT.isoformat()}")
    assert len([f for f in os.listdir(hot_dir) if f.endswith(".parquet")]) > 1
    back = TB.read_route_hourly(spark, root)
    assert back.count() == total
    assert back.where(F.col("aggregation_date") == F.lit(HOT)).count() > total / 3


def test_hot_date_is_split_with_adaptive_execution_off(spark, tmp_path):
    """With adaptive execution off (as the source application ran), the date
    rebalance would be a plain hash repartition; range partitioning on the
    date and keys still spreads a hot date over several writer tasks."""
    from fixtures import plan_text

    hourly = catalog.route_hourly(spark, SF01)
    skewed = TB.conform(
        hourly.withColumn(
            "aggregation_date", F.when(F.col("hour") < 20, F.lit(HOT)).otherwise(F.col("aggregation_date"))
        ),
        C.ROUTE_HOURLY,
    )
    total = skewed.count()
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    root = str(tmp_path / "no_aqe")
    try:
        assert "rangepartitioning(aggregation_date" in plan_text(TB._by_date(skewed, "aggregation_date", False, ["aggregation_date", "hour"]))
        TB.write_curated(skewed, root, C.ROUTE_HOURLY)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    table = TB.table_path(root, C.ROUTE_HOURLY)
    hot_dir = os.path.join(table, f"aggregation_date={HOT.isoformat()}")
    assert len([f for f in os.listdir(hot_dir) if f.endswith(".parquet")]) > 1
    # small dates stay whole: one file each, two where a range bound cuts one
    small = [
        len([f for f in os.listdir(os.path.join(table, d)) if f.endswith(".parquet")])
        for d in os.listdir(table)
        if "=" in d and d != f"aggregation_date={HOT.isoformat()}"
    ]
    assert small and max(small) <= 2
    back = TB.read_route_hourly(spark, root)
    assert back.count() == total
