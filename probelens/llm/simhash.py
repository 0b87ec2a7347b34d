"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints: words of the ASCII-lower-cased text, shingles of ``width`` words
with repeats, XXH64 of each; a bit is set when over half the hashes set it.

Candidates: the 64 bits are cut into ``BLOCKS`` blocks. Two fingerprints within
``radius`` differ in at most ``radius`` blocks, so they agree on all the others:
one bucket per choice of agreeing blocks finds every pair, exactly. Only
distinct fingerprints enter, so a group of exact copies of any size is one row.

Comparison: within a bucket the fingerprints are held as vertical bit planes.
The planes of many pairs are summed at once by carry-save adders on 64-bit
words, and a block of pairs is abandoned as soon as every pair in it is beyond
the radius. Buckets of over ``MEMBERS`` fingerprints are cut into parts that meet
pairwise in tasks of their own, so no task holds an unbounded bucket. A block
emits a spanning forest of its links, never all of its pairs.

Components: alternating large-star and small-star steps over the links, each
written to the shared folder, until the links stop changing.

Defined cases: a null or blank text has fingerprint zero, linked like any other;
texts of fewer words than a shingle hash as one shingle; repeated rows share a
component; null ids are ignored for the component's smallest id (null if a
component has no other); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probelens.llm.common import row_key, ship, staged

ship(__name__)

WIDTH, RADIUS, BLOCKS, MEMBERS = 4, 4, 6, 2048
_BITS = np.arange(64, dtype=np.uint64)
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


# ------------------------------------------------------------- fingerprints
def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    ws = (text or "").encode().lower().split()
    if not ws:
        return np.zeros(0, np.uint64)
    ends = np.cumsum([len(w) + 1 for w in ws])
    starts = (ends - [len(w) + 1 for w in ws]).tolist()
    joined, ends, h = b" ".join(ws), (ends - 1).tolist(), partial(xxhash.xxh64_intdigest, seed=42)
    if len(ws) <= width:
        return np.array([h(joined)], np.uint64)
    return np.array([h(joined[a:b]) for a, b in zip(starts, ends[width - 1 :], strict=False)], np.uint64)


def fingerprint(hashes: np.ndarray, step: int = 1 << 16) -> int:
    """The 64-bit majority of the hashes, summed in slices of bounded size."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), step):
        part = hashes[at : at + step]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0]) if len(hashes) else 0


def _fingerprints(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.fromiter((fingerprint(shingle_hashes(t.as_py(), width)) for t in batch.column("__text")), np.uint64, batch.num_rows)
        yield batch.drop_columns(["__text"]).append_column("__fp", pa.array(found.view(np.int64)))


def with_fingerprint(docs: DataFrame, keep: list[str], width: int = WIDTH) -> DataFrame:
    """The kept columns and the fingerprint as a signed 64-bit ``__fp``."""
    picked = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("__text"))
    schema = picked.drop("__text").withColumn("__fp", F.lit(0).cast("long")).schema
    return picked.mapInArrow(partial(_fingerprints, width=width), schema)


# --------------------------------------------------------------- comparison
def within_radius(planes: Iterator[np.ndarray], radius: int) -> np.ndarray | None:
    """Lanes whose set planes number at most ``radius``; None once no lane is left.

    ``planes`` yields the difference bits plane by plane, 64 lanes a word. Two
    planes at a time go through a full adder with the ones counter, its carry
    ripples through the higher counters, and a carry out of the top one marks
    the lane as beyond the radius for good.
    """
    height = max(1, (radius + 1).bit_length())
    counters: list[np.ndarray] = []
    beyond = None
    for n, (a, b) in enumerate(zip(planes, planes, strict=True)):
        if beyond is None:
            counters = [np.zeros_like(a) for _ in range(height)]
            beyond = np.zeros_like(a)
        low = counters[0]
        half = low ^ a
        carry = (low & a) | (half & b)
        counters[0] = half ^ b
        for k in range(1, height):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        beyond |= carry
        if n % 4 == 3:
            beyond |= _exceeds(counters, radius)
            if (beyond == _ONES).all():
                return None
    return ~(beyond | _exceeds(counters, radius))


def _exceeds(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose bit-sliced count is over ``radius``, compared from the top bit."""
    more, equal = np.zeros_like(counters[0]), np.full_like(counters[0], _ONES)
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            more |= equal & counters[k]
            equal &= ~counters[k]
    return more


def to_planes(values: np.ndarray) -> np.ndarray:
    """(64, words): bit plane k holds bit k of every value; lanes are padded with zeros."""
    lanes = -len(values) % 64
    bits = np.unpackbits(np.concatenate([values, np.zeros(lanes, np.uint64)]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _lanes(mask: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(mask).view(np.uint8).reshape(mask.shape[0], -1), axis=1, count=n, bitorder="little")


def _filled(planes: np.ndarray, n: int) -> np.ndarray:
    """Per word, the lanes that hold no value: they count as beyond the radius."""
    used = np.zeros(planes.shape[1] * 64, np.uint8)
    used[:n] = 1
    return np.packbits(used, bitorder="little").view(np.uint64)


def block_links(left: np.ndarray, right: np.ndarray, radius: int, step: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) of left and right within the radius: queries in rows, planes in lanes."""
    planes, out_i, out_j = to_planes(right), [], []
    used = _filled(planes, len(right))
    for at in range(0, len(left), step):
        queries = left[at : at + step]
        flip = (((queries[:, None] >> _BITS) & np.uint64(1)) * _ONES).T
        near = within_radius((planes[k][None, :] ^ flip[k][:, None] for k in range(64)), radius)
        if near is not None:
            i, j = np.nonzero(_lanes(near & used, len(right)))
            out_i.append(i + at)
            out_j.append(j)
    return (np.concatenate(out_i), np.concatenate(out_j)) if out_i else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def pair_links(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Which of the listed pairs lie within the radius, a pair to a lane."""
    planes = to_planes(a ^ b)
    near = within_radius(iter(planes), radius)
    return np.zeros(len(a), bool) if near is None else _lanes(near[None, :], len(a))[0].astype(bool)


def _forest(nodes: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its group) that connect what the pairs connect."""
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    linked = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[linked], nodes[label[linked]]


def _bucket_links(batches: Iterator[pa.RecordBatch], radius: int, small: int = 48, lanes: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    """Links of bucket rows (left, right); right is empty when left meets itself."""
    for batch in batches:
        wait_a: list[np.ndarray] = []
        wait_b: list[np.ndarray] = []
        u, v, waiting = [], [], 0

        def settle() -> None:
            a, b = np.concatenate(wait_a), np.concatenate(wait_b)
            near = pair_links(a, b, radius)
            u.append(a[near])
            v.append(b[near])
            wait_a.clear()
            wait_b.clear()

        for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
            x = left.values.to_numpy(zero_copy_only=False).view(np.uint64)
            y = right.values.to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(y) and len(x) <= small:
                i, j = np.triu_indices(len(x), 1)
                wait_a.append(x[i])
                wait_b.append(x[j])
                if (waiting := waiting + len(i)) >= lanes:
                    settle()
                    waiting = 0
                continue
            i, j = block_links(x, y if len(y) else x, radius)
            nodes = np.concatenate([x, y])
            s, t = _forest(nodes, i, j + len(x) if len(y) else j)
            u.append(s)
            v.append(t)
        if wait_a:
            settle()
        if u:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(z).view(np.int64)) for z in (u, v)], names=["u", "v"])


def _block_keys(fp: Column, radius: int, blocks: int) -> list[Column]:
    """A bucket key for each choice of blocks that a pair within the radius may agree on."""
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    masks = [sum(1 << bit for bit in range(a, b)) for a, b in zip(cuts, cuts[1:], strict=False)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [F.struct(F.lit(n).alias("choice"), fp.bitwiseAND(F.lit(signed(sum(masks[k] for k in pick)))).alias("bits")) for n, pick in enumerate(combinations(range(blocks), blocks - radius))]


def links(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, members: int = MEMBERS) -> DataFrame:
    """(u, v) links that connect all distinct ``fp`` within the radius of each other."""
    if not 0 <= radius < blocks:
        raise ValueError("radius must be smaller than the number of blocks")
    keyed = staged(prints.select("fp", F.explode(F.array(*_block_keys(F.col("fp"), radius, blocks))).alias("key")).select("fp", "key.choice", "key.bits"))
    sizes = keyed.groupBy("choice", "bits").agg(F.count("*").alias("n")).where("n > 1")
    cut = keyed.join(sizes, ["choice", "bits"]).withColumn("parts", F.ceil(F.col("n") / members).cast("int"))
    part = F.pmod(F.xxhash64("fp", "choice"), F.col("parts")).cast("int")
    meets = cut.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low, high = F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")
    side = lambda first: F.collect_list(F.when(first, F.col("fp")))
    rows = meets.select("choice", "bits", low, high, "part", "fp").groupBy("choice", "bits", "low", "high").agg(side(F.col("part") == F.col("low")).alias("left"), side((F.col("part") == F.col("high")) & (F.col("low") != F.col("high"))).alias("right"))
    return rows.select("left", "right").mapInArrow(partial(_bucket_links, radius=radius), "u long, v long").distinct()


# --------------------------------------------------------------- components
def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v): root is the component's smallest node."""
    now = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    while True:
        both = now.union(now.select("v", "u"))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smaller = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smaller, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        now = staged(small)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if seen == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v"), F.col("v")).distinct())
        mark = seen


def _classified(docs: DataFrame, keep: list[str], width: int, radius: int) -> DataFrame:
    """The kept columns of every row with fp, root (a fingerprint) and component_id."""
    prints = staged(with_fingerprint(docs, keep, width).withColumnRenamed("__fp", "fp"))
    lowest = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = components(links(lowest.select("fp"), radius))
    placed = lowest.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = placed.select("fp", "root").join(names, "root")
    return prints.join(classes, "fp").select(*keep, "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text)."""
    return _classified(docs, ["doc_id"], width, radius).drop("root")


def keep_one(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """One row of each near-duplicate group: the one with the smallest id.

    A missing id comes last; rows that share an id are told apart by a hash of
    all their columns, and rows equal in every column are one.
    """
    keyed = docs.withColumn("__row", row_key(docs))
    rows = _classified(keyed, ["doc_id", "__row"], width, radius)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__row"))
    winners = rows.groupBy("root").agg(first.alias("first")).select("first.__row")
    return keyed.join(winners, "__row", "left_semi").dropDuplicates(["__row"]).drop("__row")
