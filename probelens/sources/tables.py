"""Curated Parquet tables: readers (SRC-3, SRC-4) and writers (SNK-1, SNK-2).

Curated tables are written partitioned by ``aggregation_date`` so that the
dashboard's date-range predicate prunes whole directories. Before writing,
rows are rebalanced on the date (see :func:`write_curated`): few files per
date, and a date that holds a third of all groups is split over several
tasks instead of one.
Output roots are parameters: a local path in tests, a shared URI
(``s3a://...``, ``hdfs://...``) on a cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probelens import config as C
from probelens.sources.paths import refuse_existing as refuse_existing

PARTITION_COLUMN = "aggregation_date"

_SCHEMAS = {
    C.ROUTE_DAILY: C.ROUTE_DAILY_SCHEMA,
    C.ROUTE_HOURLY: C.ROUTE_HOURLY_SCHEMA,
    C.STOP_HOURLY: C.STOP_HOURLY_SCHEMA,
}

# Column order the operators produce (grouping keys first).
_ORDER = {
    C.ROUTE_DAILY: ["Journey_Pattern_ID", "aggregation_date", "Operatorname", *C.ROUTE_MEASURES],
    C.ROUTE_HOURLY: [
        "Journey_Pattern_ID",
        "aggregation_date",
        "hour",
        "Operatorname",
        *C.ROUTE_MEASURES,
        "avg_speed",
    ],
    C.STOP_HOURLY: [
        "Stop_ID",
        "aggregation_date",
        "hour",
        "Operatorname",
        "total_count",
        "congestion_count",
        "congestion_rate",
        "avg_speed",
        "avg_delay",
    ],
}

# The key comes first within a date: a report on one route or stop then skips row
# groups by their bounds and pages by the column index, in every date's files.
_SORT_KEYS = {
    C.ROUTE_DAILY: ["aggregation_date", "Journey_Pattern_ID"],
    C.ROUTE_HOURLY: ["aggregation_date", "Journey_Pattern_ID", "hour"],
    C.STOP_HOURLY: ["aggregation_date", "Stop_ID", "hour"],
}

# Column with a bloom filter per row group: a route or stop that a file does not
# hold, though it lies between the file's bounds, is skipped without reading pages.
# Parquet writes one where a row group has too many keys for a dictionary; with few
# keys the dictionary itself is the filter, and no bloom filter is written.
_BLOOM = {C.ROUTE_DAILY: "Journey_Pattern_ID", C.ROUTE_HOURLY: "Journey_Pattern_ID", C.STOP_HOURLY: "Stop_ID"}
#: Different keys expected in a row group.
BLOOM_KEYS = 100_000


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _by_date(df: DataFrame, date_column: str, laid_out: bool, keys: list[str]) -> DataFrame:
    """Rows grouped by date before a write.

    The ``rebalance`` hint hashes rows on the date so that each date lands
    in one writer task (one file per date, not one per task and date);
    adaptive execution then merges small dates into fewer tasks and splits
    a date that holds a large share of the rows over several tasks, so file
    sizes follow the advisory partition size whatever the skew.

    Without adaptive execution (the source application switched it off)
    Spark drops the hint, and every task would write a file for every date
    it holds (measured: 240 files for 30 dates from 8 tasks). The rows are
    then range-partitioned on the date and the in-file ``keys`` instead: the
    sampled bounds split a hot date over several tasks and put small dates
    together (37 files for the same 30 dates), at the price of one sampling
    pass.

    ``laid_out`` input is a one-to-one projection of a table that was itself
    written after this step (the hourly cell base): each of its files holds
    whole dates (or one slice of a date too large for one file), and each
    scan task whole files or row groups of one file, so each task writes one
    file per date it holds, and no shuffle is needed.
    """
    if laid_out:
        return df
    if adaptive(df):
        return df.hint("rebalance", date_column)
    return df.repartitionByRange(date_column, *[k for k in keys if k != date_column])


def adaptive(df: DataFrame) -> bool:
    return df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"


def write_curated(df: DataFrame, root: str, name: str, laid_out: bool = False) -> str:
    """SNK-1/SNK-2: write one curated table under ``root``, where it must not exist yet.

    Partitioned by ``aggregation_date`` (see :func:`_by_date` for the task
    layout); rows are sorted within each file, the route or stop first, for
    tight row-group and page statistics, and that column may have bloom
    filters (FLT-3 over SRC-3).
    """
    path = table_path(root, name)
    keys = _SORT_KEYS[name]
    (
        _by_date(df, PARTITION_COLUMN, laid_out, keys)
        .sortWithinPartitions(*keys)
        .write.partitionBy(PARTITION_COLUMN)
        .option(f"parquet.bloom.filter.enabled#{_BLOOM[name]}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{_BLOOM[name]}", str(BLOOM_KEYS))
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .parquet(path)
    )
    return path


def write_base(df: DataFrame, root: str) -> str:
    """Write the hourly cell base, rebalanced on ``date``.

    The hourly route and stop tables are one-to-one projections of the
    base, so with this layout they are written map-only (``laid_out``):
    the one rebalance here replaces one per table. The base itself is not
    directory-partitioned: nothing filters it by date, and adaptive
    execution can then merge small dates into one file instead of writing
    a file per date.

    Without adaptive execution the base is written as it was aggregated:
    range partitioning samples its input first, which here would read the
    raw rows twice (and count them twice in the quality observation). The
    tables are then laid out from the written base.
    """
    path = table_path(root, C.HOURLY_BASE)
    keys = ["date", "hour", "CellID", "Operatorname"]
    laid = df.hint("rebalance", "date") if adaptive(df) else df
    laid.sortWithinPartitions(*keys).write.parquet(path)
    return path


def read_base(spark: SparkSession, root: str) -> DataFrame:
    """The written hourly cell base (declared schema, no footer inference)."""
    df = spark.read.schema(C.HOURLY_BASE_SCHEMA).parquet(table_path(root, C.HOURLY_BASE))
    return df.select(*[f.name for f in C.HOURLY_BASE_SCHEMA.fields])


def read_curated(spark: SparkSession, root: str, name: str) -> DataFrame:
    """SRC-3/SRC-4: lazy scan of one curated table, columns in operator order.

    The declared schema avoids a schema-merge pass over the footers.
    """
    df = spark.read.schema(_SCHEMAS[name]).parquet(table_path(root, name))
    return df.select(*_ORDER[name])


def read_route_hourly(spark: SparkSession, root: str) -> DataFrame:
    """SRC-3: the hourly route table (feeds the overview, route and A/B tabs)."""
    return read_curated(spark, root, C.ROUTE_HOURLY)


def read_stop_hourly(spark: SparkSession, root: str) -> DataFrame:
    """SRC-4: the hourly stop table (feeds the stop tab)."""
    return read_curated(spark, root, C.STOP_HOURLY)


def read_route_daily(spark: SparkSession, root: str) -> DataFrame:
    return read_curated(spark, root, C.ROUTE_DAILY)


def conform(df: DataFrame, name: str) -> DataFrame:
    """Cast and order an operator output to the curated layout of ``name``."""
    types = {f.name: f.dataType for f in _SCHEMAS[name].fields}
    return df.select(*[F.col(c).cast(types[c]).alias(c) for c in _ORDER[name]])

