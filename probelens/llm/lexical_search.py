r"""Ranked lexical search by dense blocked matrix products.

Every item (a short query text) is scored against every document:

    score = sum over the item's terms, repeats included, of w * impact
    w      = floor(1000 * ln((2N + 2) / (2 df + 1)))
    impact = (10^9 * tf) div (1000 * tf + 8 * m),  m = 25 + (75 * n * N) div L

with N documents that hold a term, L terms in all, n terms in the document, df
documents with the term and tf its occurrences. All of it is integer but the
logarithm, so a score is exact and ties are real ties.

Items are searched in blocks of bounded term mass. For a block, the first pass
cuts every whole text into terms and keeps the counts of the block's vocabulary
(one narrow row per document, written); from those rows come N, L and df. The
second pass multiplies tiles: the terms of a few items are a compact vocabulary
of their own, their counts one dense matrix, ``w * impact`` of these terms for
some thousand documents another, both in float64. A tile's vocabulary is cut
where a partial sum could reach 2^53, so each product is exact; products of
several tiles are added as 64-bit integers. Of each tile of documents an item
keeps its best k with all ties resolved by the smaller id, and a task emits at
most k rows per item; Spark ranks those in two steps (item and salt, then item).

Terms are maximal runs of ASCII letters and digits and of any non-ASCII
characters, A to Z lower-cased.

Defined cases: null texts and texts without a term hold nothing and don't count
in N; items without a term have no result; rows of ``items`` that are equal are
one item, and rows with one id but different texts are ranked each by itself;
repeated documents are ranked each, equal scores by ascending id, null ids last;
empty tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from probelens.llm.common import NO_ID, ship, staged

ship(__name__)

TOP = 10
#: Terms (repeats included) of the items of one block, on average: what a task is sent.
BLOCK_TERMS = 200_000
#: Items of a tile, documents of a tile and terms of a tile of the products.
ITEM_TILE, DOC_TILE, TERM_TILE = 64, 1024, 2048
EXACT = 1 << 53
#: No impact reaches this: m is 25 at least.
IMPACT = 10**6
#: Texts are cut into terms in slices of about this many bytes.
SLICE = 1 << 20
SALTS = 32
_TABLE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in b"".join(bytes([c]).lower() for c in range(256)))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in slices cut between terms."""
    text, at = text.translate(_TABLE), 0
    while at < len(text):
        end = text.find(b" ", at + SLICE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for value in batch.column("text"):
        yield (value.as_py() or "").encode()


# ------------------------------------------------------------------- tasks
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, terms, counts) of every item with a term."""
    for batch in batches:
        found = [Counter(t for part in terms(text) for t in part) for text in _texts(batch)]
        has = pa.array([bool(c) for c in found])
        out = [batch.column("item_id"), pa.array([list(c) for c in found], pa.list_(pa.binary())), pa.array([list(c.values()) for c in found], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(out, ["item_id", "terms", "counts"]).filter(has)


def _matched(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, term, tf) of every document with a term; the arrays hold vocabulary terms only."""
    get = vocabulary.get
    for batch in batches:
        sizes, ids, which, counts = [], batch.column("doc_id").to_pylist(), [], []
        for text in _texts(batch):
            n, seen = 0, Counter()
            for part in terms(text):
                n += len(part)
                seen.update([i for t in part if (i := get(t)) is not None])
            sizes.append(n)
            which.append(list(seen))
            counts.append(list(seen.values()))
        out = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(which, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(out, ["doc_id", "n", "term", "tf"]).filter(pa.array([n > 0 for n in sizes]))


def tiles(items: list[dict[int, int]], weight: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(first item, terms, counts) matrices of a few items over a slice of their own vocabulary.

    A column of ``counts`` is one term, and no row's ``count * weight * IMPACT``
    adds up to 2^53. A count that reaches it alone is split over several columns.
    """
    out = []
    for first in range(0, len(items), ITEM_TILE):
        block = items[first : first + ITEM_TILE]
        columns: list[tuple[int, dict[int, int]]] = []
        for t in sorted({t for item in block for t in item}):
            most = max(1, (EXACT - 1) // max(1, int(weight[t]) * IMPACT))
            left = {i: item[t] for i, item in enumerate(block) if t in item}
            while left:
                columns.append((t, {i: min(q, most) for i, q in left.items()}))
                left = {i: q - most for i, q in left.items() if q > most}
        tile, bound = [], [0] * len(block)
        for t, q in columns:
            grown = {i: bound[i] + n * int(weight[t]) * IMPACT for i, n in q.items()}
            if tile and (len(tile) == TERM_TILE or max(grown.values()) >= EXACT):
                out.append((first, *_dense(tile, len(block))))
                tile, bound = [], [0] * len(block)
                grown = {i: n * int(weight[t]) * IMPACT for i, n in q.items()}
            tile.append((t, q))
            for i, b in grown.items():
                bound[i] = b
        if tile:
            out.append((first, *_dense(tile, len(block))))
    return out


def _dense(tile: list[tuple[int, dict[int, int]]], rows: int) -> tuple[np.ndarray, np.ndarray]:
    counts = np.zeros((rows, len(tile)))
    for at, (_, q) in enumerate(tile):
        counts[list(q), at] = list(q.values())
    return np.array([t for t, _ in tile]), counts


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest scores above 0, equal ones by ascending id; every tie at the cut is weighed."""
    found = scores > 0
    if found.sum() > k:
        found = scores >= max(1, np.partition(scores, -k)[-k])
    scores, ids = scores[found], ids[found]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _ranked(batches: Iterator[pa.RecordBatch], items: list[dict[int, int]], weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> Iterator[pa.RecordBatch]:
    none = np.zeros(0, np.int64)
    kept = [(none, none) for _ in items]
    work = tiles(items, weight)
    for batch in batches:
        for at in range(0, batch.num_rows, DOC_TILE):
            part = batch.slice(at, DOC_TILE)
            ids = part.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            m = np.array([25 + 75 * n * n_docs // n_terms for n in part.column("n").to_pylist()], np.int64)
            lists = part.column("term")
            doc = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy(zero_copy_only=False))
            term, tf = lists.flatten().to_numpy(zero_copy_only=False), part.column("tf").flatten().to_numpy(zero_copy_only=False)
            value = (weight[term] * (10**9 * tf // (1000 * tf + 8 * m[doc]))).astype(np.float64)
            by_term = np.argsort(term, kind="stable")
            term, doc, value = term[by_term], doc[by_term], value[by_term]
            scores = np.zeros((len(items), len(ids)), np.int64)
            for first, wanted, counts in work:
                lo, hi = np.searchsorted(term, wanted), np.searchsorted(term, wanted, side="right")
                row = np.repeat(np.arange(len(wanted)), hi - lo)
                picked = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi)]) if len(row) else row
                impact = np.zeros((len(wanted), len(ids)))
                impact[row, doc[picked]] = value[picked]
                scores[first : first + len(counts)] += (counts @ impact).astype(np.int64)
            for i, (top, top_ids) in enumerate(kept):
                bar = top[-1] if len(top) == k else 1
                better = scores[i] >= bar
                if better.any():
                    kept[i] = best(np.concatenate([top, scores[i][better]]), np.concatenate([top_ids, ids[better]]), k)
    sizes = [len(s) for s, _ in kept]
    item = np.repeat(np.arange(len(items), dtype=np.int32), sizes)
    score, doc_id = (np.concatenate([x[n] for x in kept]) if kept else none for n in (0, 1))
    yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(doc_id, mask=doc_id == NO_ID), pa.array(score)], ["item", "doc_id", "score"])


# ---------------------------------------------------------------- operator
def _block(docs: DataFrame, rows: list, item_type: str, k: int) -> DataFrame | None:
    """The ranks of one block of items over all documents; None where nothing can score."""
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for r in rows for t in r.terms}))}
    items = [{vocabulary[bytes(t)]: c for t, c in zip(r.terms, r.counts)} for r in rows]
    matched = staged(docs.mapInArrow(partial(_matched, vocabulary=vocabulary), "doc_id long, n long, term array<int>, tf array<long>"))
    n_docs, n_terms = matched.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return None
    weight = np.zeros(len(vocabulary), np.int64)
    for term, df in matched.select(F.explode("term").alias("t")).groupBy("t").count().collect():  # the block's vocabulary at most
        weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    work = partial(_ranked, items=items, weight=weight, n_docs=n_docs, n_terms=n_terms, k=k)
    found = matched.mapInArrow(work, "item int, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    first = Window.partitionBy("item", "salt").orderBy(*order)
    last = Window.partitionBy("item").orderBy(*order)
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    short = salted.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    ranked = short.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
    name = F.get(F.array(*[F.lit(r.item_id).cast(item_type) for r in rows]), F.col("item"))
    return ranked.select(name.alias("item_id"), "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` best documents of every item."""
    asked = items.select("item_id", "text").distinct()
    counted = staged(asked.mapInArrow(_counted, asked.select("item_id", F.lit(None).cast("array<binary>").alias("terms"), F.lit(None).cast("array<long>").alias("counts")).schema))
    mass, n_items = counted.agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)), F.count("*")).first()
    blocks = -(-(mass or 0) // block_terms)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    item_type = dict(items.dtypes)["item_id"]
    out = []
    for b in range(blocks):
        mine = counted.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == b) if blocks > 1 else counted
        rows = mine.collect()  # one block of items, bounded by block_terms
        if rows and (found := _block(texts, rows, item_type, k)) is not None:
            out.append(found)
    empty = texts.where(F.lit(False)).select(F.lit(None).cast(item_type).alias("item_id"), F.lit(0).alias("rank"), "doc_id", F.lit(0).cast("long").alias("score"))
    return reduce(DataFrame.unionByName, out) if out else empty
