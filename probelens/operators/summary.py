"""Keyed summary table (PRJ-12, PRJ-13, PRJ-14, SET-2, SNK-3, SNK-4).

The summary holds one row per ``(route_id, time_bucket)``: daily rows have
a ``YYYY-MM-DD`` bucket, hourly rows ``YYYY-MM-DD-HH``. Loading it is a
keyed upsert where a new row replaces the whole stored row with the same
key, as a put does. On plain Parquet that is a DataFrame operation, equal
to ``new UNION ALL (current LEFT ANTI JOIN new ON key)``:

    new rows (flagged) UNION ALL stored rows
      -> one row per key: row_number() OVER (PARTITION BY key ORDER BY new first) = 1

Only the dates of the new rows are merged, each one written to a new folder;
all other dates stay where they are. The union is shuffled once,
hash-partitioned on the date and route: that clusters the key for the dedupe,
which adds only a sort within partitions (the same sort gives each file its key
order). Each input is read once (an anti join also needs the new keys as a
separate, differently pruned branch, and shuffles the stored rows a second time
for the layout). Both inputs are unique per key, so a window group holds at
most two rows: no key can be hot.

Rows whose key cannot be formed (null route, date or hour) are set aside with
the reason and counted as failed in the load report (D8) instead of failing a
batch.

A summary is a folder:

    data/load=<version>/bucket_date=<date>/   rows, written once, never changed
    rejects/<version>/                        rows of that load that cannot be stored
    manifests/<version>.json                  the folder that holds each date, the load's counts
    CURRENT                                   the version that readers see

A load writes data, rejects and manifest to new places and then replaces
``CURRENT`` by one rename, so a reader sees the old version or the new one, and
a load that dies before the rename has changed nothing. The file system has to
rename a file in one step (HDFS, local and mounted file systems do). A load that
finds another version published since it began fails and publishes nothing.
Earlier versions stay readable; folders are never deleted here.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probelens import config as C
from probelens.functions.derive import time_bucket
from probelens.sources.paths import inside, read_text, replace_file, write_text

KEY = list(C.SUMMARY_KEY)


# Summary field <- source column, stored type, value when the column is absent.
_ITEM_FIELDS = (
    ("operator", "Operatorname", "string", C.SUMMARY_UNKNOWN),
    ("avg_delay", "avg_delay", "double", 0.0),
    ("max_delay", "max_delay", "int", 0),
    ("min_delay", "min_delay", "int", 0),
    ("trip_count", "trip_count", "bigint", 0),
    ("congestion_count", "congestion_count", "bigint", 0),
    ("congestion_rate", "congestion_rate", "double", 0.0),
)


def _field(df: DataFrame, source: str, default) -> Column:
    return F.col(source) if source in df.columns else F.lit(default)


def _item_columns(df: DataFrame, bucket: Column, updated_at: str) -> list[Column]:
    """PRJ-13 + PRJ-14: the ten summary fields with their stored types.

    A field whose source column is absent takes the default (``unknown``
    for text, 0 for numbers); a present but null value stays null, and a
    row with a null key or operator is later counted as failed (D8).
    """
    cols = [
        _field(df, "Journey_Pattern_ID", C.SUMMARY_UNKNOWN).cast("string").alias("route_id"),
        bucket.alias("time_bucket"),
    ]
    cols += [_field(df, src, default).cast(typ).alias(name) for name, src, typ, default in _ITEM_FIELDS]
    cols.append(F.lit(updated_at).alias("updated_at"))
    return cols


def daily_items(daily: DataFrame, updated_at: str) -> DataFrame:
    """PRJ-12/13 for the daily table: bucket ``YYYY-MM-DD``."""
    return daily.select(*_item_columns(daily, time_bucket("aggregation_date"), updated_at))


def hourly_items(hourly: DataFrame, updated_at: str) -> DataFrame:
    """PRJ-12/13 for the hourly table: bucket ``YYYY-MM-DD-HH``."""
    return hourly.select(*_item_columns(hourly, time_bucket("aggregation_date", "hour"), updated_at))


def summary_items(daily: DataFrame, hourly: DataFrame, updated_at: str) -> DataFrame:
    """SET-2: daily and hourly items in one frame; told apart by the bucket.

    ``updated_at`` is passed in (an ISO-8601 UTC text) so that a load is
    deterministic and every row of one load carries the same stamp.
    """
    return daily_items(daily, updated_at).unionByName(hourly_items(hourly, updated_at))


def valid_item() -> Column:
    """A row can be stored when its key and operator are present."""
    return F.col("route_id").isNotNull() & F.col("time_bucket").isNotNull() & F.col("operator").isNotNull()


def reject_reason() -> Column:
    """The fields that keep a row from being stored, comma-joined; empty for a valid row."""
    needed = ("route_id", "time_bucket", "operator")
    return F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(f"{c} missing")) for c in needed])


def rejects(items: DataFrame) -> DataFrame:
    """The rows of a load that cannot be stored, with the reason."""
    return items.where(~valid_item()).withColumn("reason", reject_reason())


def _merge(current: DataFrame | None, new_items: DataFrame) -> DataFrame:
    """New rows (flagged ``_new``) and, if any, the stored rows, unioned."""
    merged = new_items.withColumn("_new", F.lit(True))
    if current is None:
        return merged
    return merged.unionByName(current.withColumn("_new", F.lit(False)), allowMissingColumns=True)


def _one_per_key(rows: DataFrame, merging: bool, key: list[str] | None = None) -> DataFrame:
    """Keep the new row of a key if there is one, else the stored row.

    Called on valid rows only, so a new row without a key never shadows a
    stored one. A first load (nothing stored) needs no dedupe.
    """
    if not merging:
        return rows.drop("_new")
    w = Window.partitionBy(*(key or KEY)).orderBy(F.col("_new").desc())
    return rows.withColumn("_pick", F.row_number().over(w)).where(F.col("_pick") == 1).drop("_pick", "_new")


def upsert(current: DataFrame | None, new_items: DataFrame) -> DataFrame:
    """SNK-3: new rows replace stored rows with the same key; others stay.

    ``new_items`` must be unique per key (``summary_items`` is, by
    construction: each source table has one row per group). Rows that
    cannot be stored are dropped here; see :func:`rejects`.
    """
    return _one_per_key(_merge(current, new_items).where(valid_item()), current is not None)


def load_report(items: DataFrame) -> DataFrame:
    """SNK-4 as a one-row frame: ``success``, ``failed``, ``total``."""
    ok = valid_item()
    return items.agg(
        F.count_if(ok).alias("success"),
        F.count_if(~ok).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


GRAINS = ("daily", "hourly")
#: Partition column of a written summary: the date of the bucket.
BUCKET_DATE = "bucket_date"


def _bucket_date() -> Column:
    return F.substring("time_bucket", 1, 10)


def _tagged(grains: dict[str, DataFrame]) -> DataFrame:
    """The items of all grains, with the grain's name."""
    out = None
    for name, items in grains.items():
        mine = items.withColumn("grain", F.lit(name))
        out = mine if out is None else out.unionByName(mine)
    return out


def write_upsert(spark: SparkSession, root: str, grains: dict[str, DataFrame], inputs: list[str] | tuple[str, ...] = ()) -> dict:
    """SNK-3 + SNK-4: upsert into the summary at ``root``; return the load report.

    ``grains`` are the new items by grain, ``inputs`` the paths they are read
    from, which must lie apart from ``root`` whatever way they are spelt.

    Only dates that the new items touch are merged and shuffled; the manifest
    keeps the folders of all others. The touched dates come to the driver, one
    value per calendar day of the load. The report counts the rows that this
    load has written, in the files that the new version consists of, so a task
    that ran twice counts once.
    """
    for p in inputs:
        if inside(spark, root, p):
            raise ValueError(f"summary {root} and its input {p} overlap; write to another place")
    parent = current_version(spark, root)
    held = manifest(spark, root, parent)["dates"] if parent else {}
    version = f"{int(parent.split('-')[0]) + 1 if parent else 1:08d}-{uuid.uuid4().hex[:8]}"
    new_items = _tagged(grains).withColumn("loaded_by", F.lit(version))

    dates = [r[0] for r in new_items.where(valid_item()).select(_bucket_date().alias("d")).distinct().collect()]
    stored = _stored(spark, root, {d: held[d] for d in dates if d in held})
    upsert_layout(stored, new_items).write.partitionBy(BUCKET_DATE).parquet(_load_path(root, version))
    rejects(new_items).drop("loaded_by").write.parquet(_rejects_path(root, version))

    counts = {r["grain"]: r.asDict() for r in _committed(spark, root, version, grains).collect()}  # one row per grain
    report = {g: {k: counts[g][k] for k in COUNTS} for g in grains}
    report = {**{k: sum(report[g][k] for g in grains) for k in COUNTS}, **report}
    publish(spark, root, version, parent, {**held, **dict.fromkeys(dates, version)}, report)
    return {**report, "version": version}


COUNTS = ("success", "failed", "total")


def _load_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/data/load={version}"


def _rejects_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/rejects/{version}"


def _pointer(root: str) -> str:
    return f"{root.rstrip('/')}/CURRENT"


def _manifest_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/manifests/{version}.json"


def current_version(spark: SparkSession, root: str) -> str | None:
    """The published version; None where there is none yet."""
    found = read_text(spark, _pointer(root))
    return found.strip() if found else None


def manifest(spark: SparkSession, root: str, version: str) -> dict:
    """``dates`` (the load that holds each date), ``report`` and ``parent`` of a version."""
    found = read_text(spark, _manifest_path(root, version))
    if found is None:
        raise FileNotFoundError(f"no version {version} of the summary at {root}")
    return json.loads(found)


def publish(spark: SparkSession, root: str, version: str, parent: str | None, dates: dict[str, str], report: dict) -> None:
    """Make a written version the one that readers see, in one step."""
    write_text(spark, _manifest_path(root, version), json.dumps({"version": version, "parent": parent, "dates": dates, "report": report}, sort_keys=True))
    fresh = f"{_pointer(root)}.{version}"
    write_text(spark, fresh, version)
    if current_version(spark, root) != parent:
        raise RuntimeError(f"another load has published {current_version(spark, root)} at {root} since this one began; load again")
    replace_file(spark, fresh, _pointer(root))


_STORED = T.StructType(
    [
        *C.SUMMARY_SCHEMA.fields,
        T.StructField("grain", T.StringType()),
        T.StructField("loaded_by", T.StringType()),
        T.StructField("load", T.StringType()),
        T.StructField(BUCKET_DATE, T.StringType()),
    ]
)


def _stored(spark: SparkSession, root: str, dates: dict[str, str]) -> DataFrame | None:
    """The rows of the given dates, each date from the load that holds it; None for no dates."""
    if not dates:
        return None
    paths = [f"{_load_path(root, load)}/{BUCKET_DATE}={d}" for d, load in sorted(dates.items())]
    return spark.read.schema(_STORED).option("basePath", f"{root.rstrip('/')}/data").parquet(*paths).drop("load", BUCKET_DATE)


def read_summary(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """The rows of the published version, or of an earlier one."""
    version = version or current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no summary has been published at {root}")
    rows = _stored(spark, root, manifest(spark, root, version)["dates"])
    return (spark.createDataFrame([], _STORED) if rows is None else rows).select(*[f.name for f in C.SUMMARY_SCHEMA.fields])


_REJECTED = T.StructType([*C.SUMMARY_SCHEMA.fields, T.StructField("grain", T.StringType()), T.StructField("reason", T.StringType())])


def read_rejects(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """The rows that a load (the last one, if not named) could not store, with grain and reason."""
    version = version or current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no summary has been published at {root}")
    return spark.read.schema(_REJECTED).parquet(_rejects_path(root, version))


def _committed(spark: SparkSession, root: str, version: str, grains) -> DataFrame:
    """(grain, success, failed, total) of a load, counted in the files it has written."""
    data = spark.read.schema(T.StructType([f for f in _STORED.fields if f.name != "load"])).parquet(_load_path(root, version))
    ok = data.where(F.col("loaded_by") == version).select("grain", F.lit(1).alias("ok"))
    bad = read_rejects(spark, root, version).select("grain", F.lit(0).alias("ok"))
    none = spark.range(1).select(F.explode(F.array(*map(F.lit, grains))).alias("grain"), F.lit(None).cast("int").alias("ok"))
    rows = ok.unionByName(bad).unionByName(none)
    return rows.groupBy("grain").agg(F.count_if(F.col("ok") == 1).alias("success"), F.count_if(F.col("ok") == 0).alias("failed"), F.count("ok").alias("total"))


def committed_report(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """SNK-4 from the committed output: (grain, success, failed, total) of a load."""
    version = version or current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no summary has been published at {root}")
    known = manifest(spark, root, version)["report"]
    return _committed(spark, root, version, [g for g in known if g not in COUNTS])


def upsert_layout(current: DataFrame | None, new_items: DataFrame) -> DataFrame:
    """The rows :func:`write_upsert` merges, in the order it writes them.

    One exchange over the union, hash-partitioned on the bucket's date and the
    route (so keys are clustered for the pick, and a date's rows are spread
    over tasks by route), then the per-key pick and the in-file order, both
    served by one sort within each partition.
    """
    rows = _merge(current, new_items).where(valid_item()).withColumn(BUCKET_DATE, _bucket_date())
    # no explicit partition count: adaptive execution sizes partitions by bytes
    laid_out = rows.repartition(BUCKET_DATE, "route_id")
    return _one_per_key(laid_out, current is not None, [BUCKET_DATE, *KEY]).sortWithinPartitions(BUCKET_DATE, *KEY)
