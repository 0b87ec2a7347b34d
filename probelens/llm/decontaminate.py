"""Benchmark decontamination by size-partitioned MinHash containment search.

A document leaks a test item when it contains at least ``threshold`` of the
item's distinct five-word shingles. Items are short and documents long, so the
MinHash sketch is taken of the item alone and looked up in the whole document.

Items are partitioned by size (powers of two). The sketch of an item is its
``s`` smallest shingle hashes, with ``s`` one more than the number of shingles
that an item of its partition may miss at the threshold. A document that reaches
the threshold thus holds at least one sketch hash: the search loses nothing, for
any partition, while the sketch stays near a fifth of the item. Documents with
fewer shingles than an item needs are left out before verification.
Candidates are verified by exact containment of the shingles' own text.

Words are lower-cased and split at ASCII white space. An item of fewer words than a
shingle is one shingle of all its words, looked up among the document's shingles of
that length; only lengths that some item has are cut.

Plan: the sketch is the small side. Its row count is checked: up to
``BROADCAST_ROWS`` it is broadcast, and beyond that both sides are shuffled on
the hash. Candidates are keyed by the hash of the text, so exact copies are
searched once each and verified once; only (text, item) pairs are shuffled.

Defined cases: null texts leak nothing, and short ones only items as short; items
without a word are never found; repeated items and
documents give one row per (doc_id, item_id), the largest containment; empty
tables give an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probelens.llm.common import identity, let, staged, words

WIDTH = 5
THRESHOLD = 0.8
#: Rows of (hash, item) that may be broadcast: 16 bytes each, 16 MB.
BROADCAST_ROWS = 1_000_000


def _starts(ws: Column, width: int) -> Column:
    return F.when(F.size(ws) >= width, F.sequence(F.lit(0), F.size(ws) - width)).otherwise(F.array().cast("array<int>"))


def _hashes(text: Column, width: int) -> Column:
    """The shingle hashes of a text, in order, with repeats."""
    each = lambda ws: F.transform(_starts(ws, width), lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(width)]))
    return let(F.transform(words(F.lower(text)), lambda w: F.xxhash64(w)), each)


def _shingles(text: Column, width: int) -> Column:
    """The distinct shingles of a text."""
    each = lambda ws: F.transform(_starts(ws, width), lambda i: F.concat_ws(" ", *[F.get(ws, i + k) for k in range(width)]))
    return F.array_distinct(let(words(F.lower(text)), each))


def _needed(n: Column, threshold: float) -> Column:
    """Shingles that a match must share; the margin keeps 0.8 * 5 at 4."""
    return F.ceil(n * F.lit(threshold) - F.lit(1e-9)).cast("int")


def _each_width(cut, text: Column, widths: list[int]) -> Column:
    """The shingles (or hashes) of several lengths, one after the other."""
    return F.concat(*[cut(text, w) for w in widths])


def item_sketches(items: DataFrame, width: int, threshold: float) -> DataFrame:
    """(item_id, width, shingles, n, band, sketch) of every item that has a word."""
    sized = items.withColumn("width", F.least(F.size(words(F.lower("text"))), F.lit(width)))
    of_width = lambda cut: F.coalesce(*[F.when(F.col("width") == w, cut(F.col("text"), w)) for w in range(1, width + 1)])
    base = sized.where("width > 0").select("item_id", "width", F.array_distinct(of_width(_shingles)).alias("shingles"), F.array_sort(F.array_distinct(of_width(_hashes))).alias("hashes"))
    sized = base.withColumn("n", F.size("shingles")).where("n > 0").withColumn("band", F.floor(F.log2("n")).cast("int"))
    largest = F.pow(F.lit(2.0), F.col("band") + 1).cast("int") - 1
    sketch = F.slice("hashes", 1, largest - _needed(largest, threshold) + 1)
    return sized.select("item_id", "width", "shingles", "n", "band", sketch.alias("sketch"))


def leaks(docs: DataFrame, items: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """(text_hash, item_id, n_shared, n_item) of every text that contains an item."""
    if not 0 < threshold <= 1 or math.isnan(threshold):
        raise ValueError("threshold must lie in (0, 1]")
    sketches = staged(item_sketches(items.select("item_id", "text"), width, threshold))
    probes = staged(sketches.select("item_id", "n", F.explode("sketch").alias("h")))
    small = probes.count() <= BROADCAST_ROWS
    widths = sorted(sketches.agg(F.collect_set("width")).first()[0]) or [width]
    texts = docs.where(F.col("text").isNotNull()).select(identity("text").alias("text_hash"), "text")
    grams = texts.select("text_hash", _each_width(_hashes, F.col("text"), widths).alias("hs")).select("text_hash", F.size("hs").alias("n_doc"), "hs").select("text_hash", "n_doc", F.explode("hs").alias("h"))
    hits = grams.join(F.broadcast(probes) if small else probes, "h").where(F.col("n_doc") >= _needed(F.col("n"), threshold))
    candidates = staged(hits.select("text_hash", "item_id").distinct())

    c, i = candidates.alias("c"), sketches.alias("i")
    wanted = c.join(i, F.col("c.item_id").eqNullSafe(F.col("i.item_id"))).select("c.text_hash", "c.item_id", "shingles", "n")
    suspects = texts.join(candidates.select("text_hash").distinct(), "text_hash", "left_semi").dropDuplicates(["text_hash"])
    suspects = suspects.select("text_hash", _each_width(_shingles, F.col("text"), widths).alias("has"))
    shared = F.size(F.array_intersect("has", "shingles"))
    verified = suspects.join(wanted, "text_hash").select("text_hash", "item_id", shared.alias("n_shared"), F.col("n").alias("n_item"))
    return verified.where(F.col("n_shared") >= _needed(F.col("n_item"), threshold))


def contaminated_pairs(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) of every document that contains an item."""
    found = staged(leaks(docs, items, **options))
    held = docs.where(F.col("text").isNotNull()).select("doc_id", identity("text").alias("text_hash"))
    best = F.max(F.struct(F.col("n_shared") / F.col("n_item"), "n_shared", "n_item"))
    pairs = held.join(found, "text_hash").groupBy("doc_id", "item_id").agg(best.alias("b"))
    return pairs.select("doc_id", "item_id", F.col("b.n_shared").cast("long").alias("n_shared"), F.col("b.n_item").cast("long").alias("n_item"), (F.col("b.n_shared") / F.col("b.n_item")).alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that contain no item; null texts stay."""
    found = staged(leaks(docs, items, **options).select(F.col("text_hash").alias("__hash")).distinct())
    return docs.withColumn("__hash", F.when(F.col("text").isNotNull(), identity("text"))).join(found, "__hash", "left_anti").drop("__hash")
