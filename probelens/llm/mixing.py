"""Mixing sources to target weights by weighted fair queueing.

Every document gets a virtual finish time: the cumulative size of its source,
in a shuffled order, divided by the source's weight. Copies of a document in
later epochs finish one whole source size later. The copies are range-sorted by
finish time over the whole cluster and the queue is cut at the total budget, so
sources are served in proportion to their weights until one runs out of epochs
and leaves its share to the others.

Plan: texts are read once into a narrow table (id, source, size, digest). The
shuffled order is cut into ``BUCKETS`` ranges per source, so a source that holds
a third of all rows is summed in that many groups; running sums add the offset
of their bucket. The queue is range-partitioned, written, and numbered by
partition sums plus a running sum within each partition.

Defined cases: a null text has size 0; a null source is a source of its own and
sorts last; rows equal in id, source and text stand and fall together; documents
of size 0 take nothing; an empty table gives an empty mix. Input columns named
as result columns are replaced by them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from probelens.llm.common import staged, words, without

#: Ranges of the shuffled order per source (three hexadecimal digits).
BUCKETS = 16**3
RESULT = ("size", "source_size", "weight", "target", "copies", "taken")


def cycled_weights(sizes: DataFrame, cycle: tuple[int, ...]) -> DataFrame:
    """Weights for a per-source table, cycling over the sources by code point, null last.

    The table has one row per source, so one task orders names, never documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    at = F.pmod(F.row_number().over(order) - 1, F.lit(len(cycle)))
    return sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, cycle)), at.cast("int") + 1))


def targets(sizes: DataFrame, budget_share: float, max_epochs: int) -> DataFrame:
    """Targets of (source, source_size, weight) rows: shares by weight, capped.

    With sources in order of cap over weight, the common level is the budget
    left by the capped ones over the weights of the others, at the first source
    that level does not cap.
    """
    cap = F.col("source_size") * max_epochs
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = (
        sizes.withColumn("cap", cap)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(budget_share))
        .withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(rest))
        .withColumn("at", F.row_number().over(by_ratio))
    )
    fits = F.when(F.col("level") <= F.col("ratio"), F.struct("at", "level"))
    level = F.min(fits).over(everything)["level"]
    target = F.least(F.col("cap").cast("double"), F.coalesce(level * F.col("weight"), F.col("cap").cast("double")))
    return levels.withColumn("target", target).select("source", "source_size", "weight", "target", "budget")


def mix(docs: DataFrame, cycle: tuple[int, ...] = (5, 2, 1), budget_share: float = 1.0, max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): its size and what the mix takes.

    Columns: doc_id, source, digest, size, source_size, weight, target, copies,
    taken. ``digest`` is the MD5 of the text (null text: null).
    """
    narrow = staged(docs.select("doc_id", "source", F.md5(F.col("text").cast("binary")).alias("digest"), F.size(words(F.col("text"))).cast("long").alias("size")))
    units = narrow.groupBy("doc_id", "source", "digest", "size").agg(F.count("*").alias("rows"))
    name = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("digest", F.lit("-")))
    units = units.withColumn("shuffle", F.md5(name)).withColumn("bucket", F.substring("shuffle", 1, 3))
    amount = F.col("size") * F.col("rows")

    per_bucket = units.groupBy("source", "bucket").agg(F.sum(amount).alias("tokens"))
    sizes = per_bucket.groupBy("source").agg(F.sum("tokens").alias("source_size"))
    plan = targets(cycled_weights(sizes, cycle), budget_share, max_epochs)
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.withColumn("offset", F.coalesce(F.sum("tokens").over(earlier), F.lit(0))).drop("tokens")
    o, p = offsets.alias("o"), plan.alias("p")
    offsets = o.join(p, F.col("o.source").eqNullSafe(F.col("p.source"))).select("o.source", "bucket", "offset", "source_size", "weight", "target", "budget")

    u, o = units.alias("u"), offsets.alias("o")
    joined = u.join(o, F.col("u.source").eqNullSafe(F.col("o.source")) & (F.col("u.bucket") == F.col("o.bucket"))).drop(F.col("o.source"), F.col("o.bucket"))
    shuffled = Window.partitionBy("source", "bucket").orderBy("shuffle", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    timed = joined.withColumn("served", F.col("offset") + F.sum(amount).over(shuffled))
    finish = (F.col("served") + F.col("epoch") * F.col("source_size")) / F.col("weight")
    queue = timed.withColumn("epoch", F.explode(F.array(*map(F.lit, range(max_epochs))))).withColumn("finish", finish)

    order = ["finish", "source", "shuffle", "doc_id", "epoch"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    queue = staged(queue.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    lengths = queue.groupBy("part").agg(F.sum(amount).alias("tokens"))
    starts = lengths.withColumn("start", F.coalesce(F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("tokens")
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ranked = queue.withColumn("run", F.sum(amount).over(within)).join(starts, "part")
    fits = F.col("start") + F.col("run") <= F.col("budget")
    taken = ranked.groupBy("doc_id", "source", "digest", "size", "rows", "source_size", "weight", "target").agg(F.sum(F.when(fits & (F.col("size") > 0), 1).otherwise(0)).alias("copies"))
    each = taken.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows")))).drop("row", "rows")
    return each.withColumn("taken", F.col("copies") * F.col("size"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mix takes, with all their columns and ``RESULT``.

    A document with ``copies`` = 0 lies beyond the cut and is not in the mix;
    one with 2 or 3 is to be repeated that often.
    """
    decided = mix(docs, **options).select("doc_id", "source", "digest", *RESULT).distinct().where("copies > 0")
    left = without(docs, *RESULT).withColumn("__digest", F.md5(F.col("text").cast("binary"))).alias("d")
    right = decided.alias("m")
    same = F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & F.col("d.source").eqNullSafe(F.col("m.source")) & F.col("d.__digest").eqNullSafe(F.col("m.digest"))
    kept = [F.col(f"d.`{c}`") for c in left.columns if c != "__digest"]
    return left.join(right, same).select(*kept, *[F.col(f"m.{c}") for c in RESULT])
