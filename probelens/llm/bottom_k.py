"""Document fingerprints: bottom-k sketches of word shingles.

The sketch of a text is the ``k`` smallest distinct hashes of its five-word
shingles, ascending. A text of fewer words is one shingle of all its words; a
text without a word has an empty sketch. Words are lower-cased and split at
ASCII white space.

Sketches of parts merge: the ``k`` smallest of the union of two sketches are the
sketch of both parts together (:func:`union`; :func:`merged` does it for groups
of rows). From sketches alone follow

* the number of distinct shingles: exact below ``k``, else ``(k - 1)`` over the
  share of the hash range that the sketch covers;
* the resemblance of two texts: the share of the union's sketch that lies in
  both;
* the containment of one text in another: resemblance times the distinct
  shingles of the union over those of the first.

Plan of :func:`with_successor`, which sets each document beside the next one by
id: the order is taken over narrow rows (id and two hashes of the text), range
partitioned with a number of ranges that grows as the root of the rows; the last
row of each range is handed to the range behind it. Each document then sends
the part of its text that its predecessor needs, with its own sketch, to the
predecessor. Texts are shuffled once, and about a quarter of them a second time;
all of it is built-in functions.

Defined cases: a null text is an empty one; null ids come last; documents with
equal ids are ordered by hashes of their texts, and rows equal in both id and
text count once in the order and get equal results; the last document is followed
by the first, a single one by itself; two empty sketches resemble each other
fully, an empty and another one not at all; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from probelens.llm.common import NO_ID, let, staged, words

WIDTH = 5
SIZE = 128
_RANGE = 2.0**64


# ---------------------------------------------------------------- sketches
def _hashes(text: Column, width: int) -> Column:
    def each(ws: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(ws) - F.lit(width))
        full = F.transform(starts, lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(width)]))
        short = F.array(F.aggregate(ws, F.lit(42).cast("long"), lambda a, x: F.xxhash64(a, x)))
        return F.when(F.size(ws) >= width, full).when(F.size(ws) > 0, short).otherwise(F.array().cast("array<long>"))

    return let(F.transform(words(F.lower(text)), lambda w: F.xxhash64(w)), each)


def sketch(text: Column, k: int = SIZE, width: int = WIDTH) -> Column:
    """The ``k`` smallest distinct shingle hashes of a text, ascending."""
    return F.slice(F.array_sort(F.array_distinct(_hashes(text, width))), 1, k)


def union(a: Column, b: Column, k: int = SIZE) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def merged(sketches: DataFrame, by: list[str], column: str = "sketch", k: int = SIZE) -> DataFrame:
    """One sketch per group of rows.

    A group may hold any share of the rows: each hash of a group counts once
    after a partial aggregation, the ranking by (group, salt) leaves ``k`` of
    each salt, and only those meet in one task.
    """
    hashes = sketches.select(*by, F.explode(column).alias("h")).distinct().withColumn("salt", F.pmod("h", F.lit(64)))
    near = hashes.withColumn("at", F.row_number().over(Window.partitionBy(*by, "salt").orderBy("h"))).where(F.col("at") <= k)
    least = near.withColumn("at", F.row_number().over(Window.partitionBy(*by).orderBy("h"))).where(F.col("at") <= k)
    return least.groupBy(*by).agg(F.array_sort(F.collect_list("h")).alias(column))


def n_distinct(s: Column, k: int = SIZE) -> Column:
    """Estimated number of distinct shingles; exact for sketches that are not full."""
    covered = (F.element_at(s, k).cast("double") + F.lit(_RANGE / 2)) / F.lit(_RANGE)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise(F.lit(k - 1.0) / covered)


def resemblance(a: Column, b: Column, k: int = SIZE) -> Column:
    """Share of the shingles of both texts that both hold, from 0 to 1."""
    both = let(union(a, b, k), lambda u: F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both)


def containment(a: Column, b: Column, k: int = SIZE) -> Column:
    """Share of the shingles of the first text that the second holds, from 0 to 1."""
    share = resemblance(a, b, k) * n_distinct(union(a, b, k), k) / n_distinct(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), share))


def described(s: Column) -> Column:
    """A sketch as a string: 16 hexadecimal digits per hash."""
    return F.array_join(F.transform(s, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


# --------------------------------------------------------------- successor
def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(a, b, c, text): the id, or ``NO_ID``, and two hashes of the text."""
    content = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("a"), content.alias("text"))
    return base.select("a", F.xxhash64("text").alias("b"), F.xxhash64(F.lit(7), F.col("text")).alias("c"), "text")


KEY = ["a", "b", "c"]


def _predecessors(keyed: DataFrame) -> DataFrame:
    """(a, b, c, pa, pb, pc, pn) of each different document: the one before it and that one's length."""
    narrow = staged(keyed.select(*KEY, F.length("text").alias("n")).distinct())
    ranges = 1 + math.isqrt(narrow.count()) // 8
    ordered = staged(narrow.repartitionByRange(ranges, *KEY).withColumn("part", F.spark_partition_id()))
    row = F.struct(*KEY, "n")
    ends = ordered.groupBy("part").agg(F.max(row).alias("end"))
    by_part = Window.orderBy("part")
    # One row per range: the end of the range before, and for the first range the end of the last.
    follower = F.coalesce(F.lead("part", 1).over(by_part), F.first("part").over(by_part))
    gap = ends.select(follower.alias("part"), "end")
    within = ordered.withColumn("p", F.lag(row, 1).over(Window.partitionBy("part").orderBy(*KEY)))
    joined = within.join(F.broadcast(gap), "part")
    p = F.coalesce("p", "end")
    return joined.select(*KEY, *[p.getField(c).alias(f"p{c}") for c in (*KEY, "n")])


def with_successor(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = 4, k: int = SIZE) -> DataFrame:
    """(doc_id, text, head, next_sketch): ``head`` is the start of the next document's text,
    as many code points as a ``share``-th of this one's (or all)."""
    keyed = _keyed(docs, doc_id, text)
    links = staged(_predecessors(keyed))
    start = F.expr(f"substring(text, 1, pn div {share})")
    sent = keyed.join(links, KEY).select(F.col("pa").alias("a"), F.col("pb").alias("b"), F.col("pc").alias("c"), start.alias("head"), F.col("text").alias("whole"))
    sent = sent.select(*KEY, F.struct("head", sketch(F.col("whole"), k).alias("sketch")).alias("s"))
    # Equal rows send the same; the sketch travels with the head, so one value serves for all.
    once = sent.dropDuplicates(KEY)
    own_id = F.when(F.col("a") != NO_ID, F.col("a"))
    return keyed.join(once, KEY).select(own_id.alias("doc_id"), "text", F.col("s.head").alias("head"), F.col("s.sketch").alias("next_sketch"))


def edited(share: int = 4) -> Column:
    """The text with its last ``share``-th replaced by the head of the next document."""
    return F.concat(F.expr(f"substring(text, 1, length(text) - length(text) div {share})"), F.col("head"))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = 4, k: int = SIZE) -> DataFrame:
    """(doc_id, text, edited, sketch, edited_sketch, next_sketch) of every document."""
    beside = with_successor(docs, doc_id, text, share, k).withColumn("edited", edited(share))
    return beside.select("doc_id", "text", "edited", sketch(F.col("text"), k).alias("sketch"), sketch(F.col("edited"), k).alias("edited_sketch"), "next_sketch")
