r"""Suffix-array deduplication: removing repeats of earlier documents' substrings.

A byte goes when a string of ``length`` bytes that covers it also starts in a
document with a smaller id. With all suffixes of a collection in order, the
longest previous factor of a position is the larger of its common prefixes with
the previous and the next smaller position (here: of an earlier document) in that
order. The byte strings to remove start where that factor reaches ``length``.

The suffix array is built in parts. The first ``length`` bytes of a suffix choose
its part: their minimizer, the smallest hash of the ``K``-byte strings in them.
Equal strings have equal minimizers, so all suffixes that share ``length`` bytes
are in one part, and the factors computed there, cut off at ``length``, are those
of the whole array. One minimizer serves a run of neighbouring suffixes, which
travel as one byte string.

Plan: (1) every text is reduced to its distinct minimizers, about one in 18 bytes;
those found in one text only are dropped, and with them nearly all suffixes that
have no earlier match. (2) Exact copies are folded into their first document; the
runs of the minimizers left are shuffled by minimizer, sorted within each task, and
give the removed spans. (3) Spans are gathered per text and cut out of it. Later
copies of a text go whole.

A minimizer of more than ``HOT_TEXTS`` texts would make its part too large for one
task. Its suffixes are not sorted but keyed one by one by a 128-bit hash of their
first ``length`` bytes: the first owner of each is a pre-aggregated minimum, and
suffixes meet it in a join that can be split. The outcome is the same.

Defined cases: a null text is empty; texts shorter than ``length`` lose nothing and
take nothing from others; a missing id counts as larger than any other; rows that
share an id take nothing from each other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probelens.llm.common import NO_ID, identity, ship, staged, without

ship(__name__)

LENGTH = 50
K = 16
#: Window starts that are handled at once, of a long text or of many runs.
STEP = 1 << 18
#: Texts that share a minimizer beyond which its suffixes are keyed by hash.
HOT_TEXTS = 50_000
_PLACE = np.uint64((1 << 21) - 1)


# --------------------------------------------------------------- minimizers
def _hashes(data: np.ndarray) -> np.ndarray:
    """A hash of each ``K``-byte string, by doubling."""
    h, factor, width = data.astype(np.uint64) + np.uint64(1), np.uint64(0x100000001B3), 1
    while width < K:
        h = h[:-width] * factor + h[width:]
        factor, width = factor * factor, width * 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    return h


def minimizers(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first, last) of each run of window starts that share a minimizer, the leftmost of the smallest."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    window = length - K + 1
    with np.errstate(over="ignore"):
        for at in range(0, len(data) - length + 1, STEP):
            h = _hashes(data[at : at + STEP + length - 1])
            low = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
            width = 1
            while width * 2 <= window:
                low = np.minimum(low[:-width], low[width:])
                width *= 2
            if width < window:
                low = np.minimum(low[: len(low) - (window - width)], low[window - width :])
            place = (low & _PLACE).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            last = np.concatenate([first[1:] - 1, [len(place) - 1]])
            found.append((h[place[first]], first + at, last + at))
    if not found:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _bytes_of(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint8) if value.is_valid else np.zeros(0, np.uint8)


def _text_minimizers(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            sets = [np.unique(minimizers(_bytes_of(x), length)[0]) for x in part.column("text")]
            row = pa.array(np.repeat(np.arange(len(sets)), [len(s) for s in sets]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64)), part.column("id").take(row), part.column("id2").take(row)], names=["h", "id", "id2"])


def _hot_suffixes(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Every suffix of the hot minimizers of each text: a 128-bit key of its first bytes, and its place."""
    reach = [*range(0, length - K + 1, K), length - K]
    for batch in batches:
        for at in range(batch.num_rows):
            part = batch.slice(at, 1)
            data = _bytes_of(part.column("text")[0])
            h, first, last = minimizers(data, length)
            keep = np.flatnonzero(np.isin(h, part.column("hot")[0].values.to_numpy().view(np.uint64)))
            starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(first[keep], last[keep], strict=True)])
            with np.errstate(over="ignore"):
                grams = _hashes(data)
                keys = [np.zeros(len(starts), np.uint64), np.ones(len(starts), np.uint64)]
                for n, factor in enumerate((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)):
                    for k in reach:
                        keys[n] = (keys[n] ^ grams[starts + k]) * np.uint64(factor)
                        keys[n] ^= keys[n] >> np.uint64(32)
            same = lambda name: pa.array(np.full(len(starts), part.column(name)[0].as_py(), np.int64))
            yield pa.RecordBatch.from_arrays([*[pa.array(x.view(np.int64)) for x in keys], same("id"), same("id2"), same("owner"), pa.array(starts)], names=["s", "t", "id", "id2", "owner", "a"])


# ----------------------------------------------------------- suffix sorting
def _runs(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The byte strings around the wanted minimizers of each text.

    A string that a text repeats is one row with all its places, so a text of
    one repeated phrase does not flood the part of its minimizer.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            hs, rows, places, strings = [], [], [], []
            for row, (text, wanted) in enumerate(zip(part.column("text"), part.column("wanted"), strict=True)):
                data, raw = _bytes_of(text), text.as_buffer().to_pybytes()
                h, first, last = minimizers(data, length)
                keep = np.flatnonzero(np.isin(h, wanted.values.to_numpy().view(np.uint64)))
                found: dict[bytes, list[int]] = {}
                new = []
                for k, a, b in zip(keep.tolist(), first[keep].tolist(), last[keep].tolist(), strict=True):
                    at_places = found.setdefault(raw[a : b + length], [])
                    if not at_places:
                        new.append(k)
                    at_places.append(a)
                hs.append(h[new])
                places += found.values()
                strings += found
                rows += [row] * len(new)
            if strings:
                of_text = [part.column(name).take(pa.array(rows)) for name in ("id", "id2", "owner")]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hs).view(np.int64)), *of_text, pa.array(places, pa.list_(pa.int64())), pa.array(strings, pa.binary())], names=["h", "id", "id2", "owner", "places", "run"])


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one big-endian number."""
    padded = np.concatenate([data, np.zeros(7, np.uint8)]).astype(np.uint64)
    for width in (1, 2, 4):
        padded = (padded[:-width] << np.uint64(8 * width)) | padded[width:]
    return padded


def reaches(data: np.ndarray, starts: np.ndarray, owners: np.ndarray, length: int) -> np.ndarray:
    """For each suffix, whether its longest previous factor reaches ``length`` bytes.

    Suffixes are sorted by their first ``length`` bytes and then by owner. Where
    the common prefix of neighbours reaches ``length`` they form an interval, in
    which owners ascend: the previous smaller position of a suffix is in its
    interval if the interval's first owner is smaller, and its next smaller
    position lies beyond the interval, with a shorter common prefix.
    """
    eight = _words(data)
    offsets = [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]
    columns = [eight[starts + k] for k in offsets]
    order = np.lexsort((owners, *reversed(columns)))
    equal = np.ones(len(order), bool)
    equal[:1] = False
    for c in columns:
        s = c[order]
        equal[1:] &= s[1:] == s[:-1]
    interval = np.cumsum(~equal) - 1
    by_owner = owners[order]
    first = by_owner[np.flatnonzero(~equal)]
    out = np.empty(len(order), bool)
    out[order] = first[interval] < by_owner
    return out


def _spans_of_runs(table: pa.Table, length: int) -> pa.RecordBatch:
    """Removed spans (id, a, b) of whole parts."""
    flat = table.combine_chunks().to_batches()[0]
    owners = flat.column("owner").to_numpy()
    run, places = flat.column("run"), flat.column("places")
    offsets = np.frombuffer(run.buffers()[1], np.int32)[run.offset : run.offset + len(run) + 1].astype(np.int64)
    data = np.frombuffer(run.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    count = np.diff(offsets) - (length - 1)
    row = np.repeat(np.arange(len(count)), count)
    within = _count_up(count)
    gone = reaches(data, offsets[row] + within, owners[row], length)
    row, within = row[gone], within[gone]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (within[1:] != within[:-1] + 1)
    begin = np.flatnonzero(new)
    end = np.concatenate([begin[1:] - 1, [len(row) - 1]]) if len(row) else begin
    # Each span stands at every place of its run.
    place_of, values = places.offsets.to_numpy().astype(np.int64), places.flatten().to_numpy()
    place_of = place_of - place_of[0]
    times = np.diff(place_of)[row[begin]]
    span = np.repeat(np.arange(len(begin)), times)
    at = values[place_of[row[begin]][span] + _count_up(times)]
    of_text = [flat.column(name).take(pa.array(row[begin][span])) for name in ("id", "id2")]
    return pa.RecordBatch.from_arrays([*of_text, pa.array(at + within[begin][span]), pa.array(at + within[end][span] + length)], names=["id", "id2", "a", "b"])


def _count_up(count: np.ndarray) -> np.ndarray:
    """0, 1, ... n - 1 for each n."""
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


def _removed(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Removed spans of runs that come sorted by minimizer: parts are kept whole, a few at a time."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        h = batch.column("h").to_numpy()
        if not len(h):
            continue
        if size >= 4 * STEP:
            # Close the parts that are complete: up to the last change of minimizer.
            changes = np.flatnonzero(h != h[-1])
            end = changes[-1] + 1 if len(changes) else 0
            if end or held[-1].column("h")[-1].as_py() != h[0]:
                yield _spans_of_runs(pa.Table.from_batches([*held, *([batch.slice(0, end)] if end else [])]), length)
                held, size, batch = [], 0, batch.slice(end)
        held.append(batch)
        size += batch.column("run").nbytes
    if held:
        yield _spans_of_runs(pa.Table.from_batches(held), length)


# ------------------------------------------------------------------ cutting
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans merged, and the bytes that are left."""
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            merged, kept = [], []
            for text, spans in zip(part.column("text"), part.column("removed").to_pylist(), strict=True):
                raw, out, pieces, end = text.as_buffer(), [], [], 0
                for s in sorted((x["a"], x["b"]) for x in spans or ()):
                    if out and s[0] <= out[-1]["b"]:
                        out[-1]["b"] = max(out[-1]["b"], s[1])
                    else:
                        out.append({"a": s[0], "b": s[1]})
                for s in out:
                    pieces.append(raw[end : s["a"]].to_pybytes())
                    end = s["b"]
                pieces.append(raw[end:].to_pybytes())
                merged.append(out)
                kept.append(b"".join(pieces))
            spans = pa.array(merged, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("id2"), part.column("owner"), pa.array([len(x.as_buffer()) for x in part.column("text")], pa.int64()), spans, pa.array(kept, pa.binary())], names=["id", "id2", "owner", "n_bytes", "spans", "kept"])


def _text_ids() -> list[Column]:
    """The two hashes that stand for a text, 128 bits; null for a null text."""
    both = identity("text")
    return [F.when(F.col("text").isNotNull(), both[bits]).alias(name) for bits, name in (("a", "id"), ("b", "id2"))]


def by_text(docs: DataFrame, length: int = LENGTH, hot_texts: int = HOT_TEXTS) -> DataFrame:
    """One row per distinct non-null text: id and id2 (its hashes), owner (its first document), n_bytes, spans (a, b), kept (binary).

    This is the outcome for the first document with that text; see :func:`of_documents` for later ones.
    """
    if length < 2 * K:
        raise ValueError(f"length must be at least {2 * K}")
    key = ["id", "id2"]
    held = docs.where(F.col("text").isNotNull()).select(*_text_ids(), F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.col("text").cast("binary").alias("text"))
    seen = held.where(F.octet_length("text") >= length).select(*key, "text").mapInArrow(partial(_text_minimizers, length=length), "h long, id long, id2 long").repartition("h")
    shared = seen.groupBy("h").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in key for f in (F.min, F.max)], F.count("*").alias("n")).where("min_id < max_id or min_id2 < max_id2")
    of_text = lambda hot: F.collect_set(F.when(F.col("hot") == hot, F.col("h")))
    wanted = seen.join(shared.select("h", (F.col("n") > hot_texts).alias("hot")), "h").groupBy(*key).agg(of_text(False).alias("wanted"), of_text(True).alias("hot"))
    wanted = staged(wanted)

    texts = held.groupBy(*key).agg(F.min("doc_id").alias("owner"), F.first("text").alias("text"))
    runs = texts.join(wanted.where(F.size("wanted") > 0), key).select(*key, "owner", "text", "wanted").mapInArrow(partial(_runs, length=length), "h long, id long, id2 long, owner long, places array<long>, run binary")
    removed = runs.repartition("h").sortWithinPartitions("h").mapInArrow(partial(_removed, length=length), "id long, id2 long, a long, b long")
    if not wanted.where(F.size("hot") > 0).isEmpty():
        suffixes = staged(texts.join(wanted.where(F.size("hot") > 0), key).select(*key, "owner", "text", "hot").mapInArrow(partial(_hot_suffixes, length=length), "s long, t long, id long, id2 long, owner long, a long"))
        firsts = suffixes.groupBy("s", "t").agg(F.min("owner").alias("first"))
        later = suffixes.join(firsts, ["s", "t"]).where(F.col("first") < F.col("owner"))
        removed = removed.union(later.select(*key, "a", (F.col("a") + length).alias("b")))
    gathered = removed.groupBy(*key).agg(F.collect_list(F.struct("a", "b")).alias("removed"))
    return texts.join(gathered, key, "left").select(*key, "owner", "text", "removed").mapInArrow(_cut, "id long, id2 long, owner long, n_bytes long, spans array<struct<a:long,b:long>>, kept binary")


def of_documents(docs: DataFrame, found: DataFrame, whole: dict[str, Column], length: int = LENGTH) -> DataFrame:
    """``docs`` with the columns of ``found``, a selection of :func:`by_text`.

    A later copy of a text of at least ``length`` bytes loses all of it: there the
    columns are as in ``whole``, which may refer to ``__n_bytes``. Null for a null text.
    """
    rest = without(docs, *whole, *(f"__{c}" for c in found.columns))
    keyed = rest.select(*[F.col(f"`{c}`") for c in rest.columns], *[c.alias(f"__{name}") for c, name in zip(_text_ids(), ("id", "id2"), strict=True)])
    joined = keyed.join(found.withColumnsRenamed({c: f"__{c}" for c in found.columns}), ["__id", "__id2"], "left")
    copy = (F.coalesce("doc_id", F.lit(NO_ID)) > F.col("__owner")) & (F.col("__n_bytes") >= length)
    return joined.select(*[F.col(f"`{c}`") for c in rest.columns], *[F.when(copy, gone).otherwise(F.col(f"__{c}")).alias(c) for c, gone in whole.items()])


def drop_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with ``kept`` (binary; null for a null text) and ``spans`` of the removed bytes."""
    every = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("__n_bytes").alias("b")))
    return of_documents(docs, by_text(docs, length), {"kept": F.lit(b""), "spans": every}, length)
