"""Centroid clustering with bit-plane popcounts.

Vectors of 64 components are turned into integers, ``floor(256 * x)``. Bit ``j``
of all 64 components is one 64-bit word, the vector's plane ``j``; the top plane
is the sign and weighs ``-2^(B-1)``. A dot product is then exact integer work:

    x . c = sum over i, j of weight(i) * weight(j) * popcount(X_i & C_j)

and ``|x|^2 - 2 x.c + |c|^2`` is the exact squared distance. ``B`` is the number
of bits that the largest component of the table needs.

Plan: the vectors are packed once and written (``B`` words and the squared norm
a vector). A round is one pass over that table without a shuffle of vectors: a
task sends at most one row per centroid (count and 64 sums), which Spark adds
up. Only the centroids (``k`` rows, a parameter) visit the driver. The last
assignment is written and its distances are added per cluster.

Defined cases: vectors that are null, of another length, or hold a null or a
non-finite component are left out; repeated vectors count each; ids that are
null are assigned like any other but start as centroids only where others run
out; equal hashes (repeated ids) are ordered by their components; fewer vectors
than ``k`` give as many centroids; an empty centroid stays where it is; an empty
table gives an empty result. Components that need over ``MAX_BITS`` bits are
refused, since squared distances would not fit 64 bits. Columns other than id
and vector are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probelens.llm.common import ship, staged

ship(__name__)

WIDTH, SCALE, MAX_BITS = 64, 256.0, 28
CENTROIDS, ROUNDS, SEED = 40, 5, "2"
#: Vectors compared at a time: their popcounts with all centroids stay in cache.
TILE = 1024


# ------------------------------------------------------------------ planes
def pack(ints: np.ndarray, bits: int) -> np.ndarray:
    """(n, 64) integers to (n, bits) words; bit ``d`` of word ``j`` is bit ``j`` of component ``d``."""
    planes = (ints[:, None, :] >> np.arange(bits)[None, :, None]) & 1
    return np.packbits(planes.astype(np.uint8), axis=2, bitorder="little").view("<u8")[..., 0]


def weights(bits: int) -> np.ndarray:
    out = np.int64(1) << np.arange(bits, dtype=np.int64)
    out[-1] = -out[-1]
    return out


def unpack(planes: np.ndarray) -> np.ndarray:
    """The integers that :func:`pack` packed."""
    n, bits = planes.shape
    ones = np.unpackbits(np.ascontiguousarray(planes).view(np.uint8).reshape(n, bits, 8), axis=2, bitorder="little")
    out = np.zeros((n, WIDTH), np.int64)
    for j, w in enumerate(weights(bits)):
        out += ones[:, j].astype(np.int64) * w
    return out


def dots(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact dot products of every row of ``x`` with every row of ``c``, both as planes."""
    bits = x.shape[1]
    out = np.zeros((len(x), len(c)), np.int64)
    for i, w in enumerate(weights(bits)):
        column = x[:, i, None]
        inner = -np.bitwise_count(column & c[None, :, bits - 1]).astype(np.int64)
        for j in range(bits - 2, -1, -1):
            inner += inner
            inner += np.bitwise_count(column & c[None, :, j])
        out += inner * w
    return out


def nearest(x: np.ndarray, norms: np.ndarray, c: np.ndarray, c_norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid (ties: the smaller number) and the squared distance, in tiles."""
    which, how_far = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for at in range(0, len(x), TILE):
        part = slice(at, at + TILE)
        far = norms[part, None] + c_norms[None, :] - 2 * dots(x[part], c)
        which[part] = far.argmin(axis=1)
        how_far[part] = far.min(axis=1)
    return which, how_far


# ------------------------------------------------------------------- tasks
def _planes(batch: pa.RecordBatch, bits: int) -> np.ndarray:
    return batch.column("planes").flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, bits)


def _norms(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("norm").to_numpy(zero_copy_only=False)


def _packed(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ints = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
        words = pa.array(pack(ints, bits).reshape(-1).view(np.int64))
        planes = pa.ListArray.from_arrays(pa.array(np.arange(len(ints) + 1, dtype=np.int32) * bits), words)
        norm = pa.array((ints * ints).sum(axis=1))
        yield pa.RecordBatch.from_arrays([batch.column("id"), planes, norm], ["id", "planes", "norm"])


def _sums(batches: Iterator[pa.RecordBatch], centers: np.ndarray) -> Iterator[pa.RecordBatch]:
    c, k, bits = centers, *centers.shape
    c_norms = (unpack(c) ** 2).sum(axis=1)
    counts, sums = np.zeros(k, np.int64), np.zeros((k, WIDTH), np.int64)
    for batch in batches:
        x = _planes(batch, bits)
        which, _ = nearest(x, _norms(batch), c, c_norms)
        counts += np.bincount(which, minlength=k)
        for at in range(0, len(x), TILE):
            np.add.at(sums, which[at : at + TILE], unpack(x[at : at + TILE]))
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used]), pa.array(sums[used].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])


def _assigned(batches: Iterator[pa.RecordBatch], centers: np.ndarray) -> Iterator[pa.RecordBatch]:
    c_norms = (unpack(centers) ** 2).sum(axis=1)
    for batch in batches:
        which, far = nearest(_planes(batch, centers.shape[1]), _norms(batch), centers, c_norms)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(which.astype(np.int32)), pa.array(far)], ["id", "cluster", "distance"])


# ---------------------------------------------------------------- operator
def usable(vectors: DataFrame, vector_id: str, vector: str) -> DataFrame:
    """(id, v) of the vectors that can be clustered, ``v`` as integers."""
    v = F.col(vector)
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    ints = F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(SCALE)))
    return vectors.where((F.size(v) == WIDTH) & F.forall(v, fine)).select(F.col(vector_id).alias("id"), ints.alias("v"))


def _moved(packed: DataFrame, centers: list[list[int]], bits: int) -> list[list[int]]:
    """The centroids after one round: the floor of each cluster's mean."""
    partial_sums = packed.mapInArrow(partial(_sums, centers=pack(np.array(centers, np.int64), bits)), "cluster long, n long, sums array<long>")
    total = lambda c: F.sum(c.cast("decimal(38,0)"))
    added = partial_sums.groupBy("cluster").agg(total(F.col("n")).alias("n"), *[total(F.get("sums", F.lit(d))).alias(f"s{d}") for d in range(WIDTH)])
    out = [list(c) for c in centers]
    for row in added.collect():  # at most one row per centroid
        out[row.cluster] = [int(row[f"s{d}"]) // int(row.n) for d in range(WIDTH)]
    return out


def cluster(vectors: DataFrame, vector_id: str = "vec_id", vector: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector.

    Starts from the ``k`` vectors with the smallest SHA-256 of ``seed:id`` and
    replaces each centroid ``rounds`` times by the floor of its cluster's mean.
    """
    kept = usable(vectors, vector_id, vector)
    low, high = kept.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    if low is None:
        return kept.select(F.col("id").alias(vector_id), *[F.lit(None).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))])
    bits = max(int(high).bit_length(), (~int(low)).bit_length() if low < 0 else 0) + 1
    if bits > MAX_BITS:
        raise ValueError(f"components need {bits} bits as integers; at most {MAX_BITS} give distances of 64 bits")
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    centers = [list(r.v) for r in kept.orderBy(place.asc_nulls_last(), "v").limit(k).collect()]

    packed = staged(kept.mapInArrow(partial(_packed, bits=bits), kept.select("id", F.col("v").alias("planes"), F.lit(0).cast("long").alias("norm")).schema))
    for _ in range(rounds):
        centers = _moved(packed, centers, bits)
    last = partial(_assigned, centers=pack(np.array(centers, np.int64), bits))
    assigned = staged(packed.mapInArrow(last, packed.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).schema))

    inertia = dict(assigned.groupBy("cluster").agg(F.sum("distance")).collect())  # one row per centroid
    of_cluster = lambda values, kind: F.get(F.array(*[F.lit(x).cast(kind) for x in values]), F.col("cluster"))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    columns: list[Column] = [of_cluster([inertia.get(c, 0) for c in range(len(centers))], "long").alias("cluster_inertia")]
    columns += [F.lit(sum(inertia.values())).cast("long").alias("inertia"), of_cluster(digests, "string").alias("centroid_sha256")]
    return assigned.select(F.col("id").alias(vector_id), "cluster", "distance", *columns)
