r"""Language-model scores by stupid backoff, computed relationally.

Words are counted over the whole corpus, longer n-grams (up to ``ORDER`` words) over
the other documents: a document's own n-grams cannot vouch for themselves, which in
a model of the same corpus would hide every backoff. A word is scored by the longest
n-gram ending there that others use: log(c(t u v) / c(t u)), else with one factor
``BACKOFF`` for each step log(c(u v) / c(u)), else log(c(v) / N). The first word of a
text has no context and no step. The score of a document is the mean over its words.

Plan: documents are dealt into blocks of about ``BLOCK_BYTES`` by hash. (1) Every
block explodes its n-grams (as 64-bit hashes) and sends each distinct one with its
count to the bucket of its hash. (2) A bucket is one part of the count table: it adds
the counts of all blocks and tells each block what the others count, in the block's
own order, so an answer needs no keys. (3) Answers and blocks are joined on the block, where the same
n-grams are exploded again, scored and summed per document.

A task holds the hashes of one block once (8 bytes for each n-gram) or its distinct
keys and their totals; sorting, counting and packing go range by range of the hash,
exploding and scoring by ``STEP`` bytes of text.

A frequent n-gram is one entry per block, never one per occurrence, so no bucket is
hot. Blocks are as many as the text asks for and buckets as many as its n-grams do,
in powers of two, so that a bucket is a prefix of the hash; each is bounded. What a
block sends to one bucket is one row: keys as gaps of six bytes, counts compressed.
All of it is one lazy plan over two shuffles of n-grams and one of texts; what is
shuffled grows with the corpus and nothing but the total size passes the driver.

Words are lower-cased runs between ASCII white space.

Defined cases: a null or blank text has no words and a null score; a text of one
word has that word's score; rows equal in id and text are one document, so that
none vouches for the other; an empty table gives an empty result. Other input
columns are left out, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probelens.llm.common import ship

ship(__name__)

BACKOFF = 0.4
#: Words of the longest n-gram.
ORDER = 3
#: A little under a power of two, to which the buffers of the texts on their way to Python grow.
BLOCK_BYTES = 15 << 20
#: Text bytes, for each word of the order, whose n-grams share a bucket.
BUCKET_BYTES = 16 << 20
#: Least bytes that are worth compressing.
SQUEEZED = 64
#: Bytes that are hashed, and later scored, at once.
STEP = 1 << 18
#: A block's n-grams are sorted and packed in ranges of their first so many bits.
RANGE_BITS = 4
#: The entry that counts all words.
TOTAL = np.uint64(0)
_BASE = 0x100000001B3
_POWERS: list[np.ndarray] = []


# ------------------------------------------------------------------- n-grams
def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.maximum(h ^ (h >> np.uint64(29)), np.uint64(1))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 ** 64."""
    if not _POWERS or len(_POWERS[0]) < n:
        made = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(max(n, STEP), base, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        _POWERS[:] = made
    return _POWERS[0][:n], _POWERS[1][:n]


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word: a polynomial in its bytes, from running sums."""
    inner = np.ones(len(data) + 2, bool)
    inner[1:-1] = (data == 32) | ((data >= 9) & (data <= 13))
    starts = np.flatnonzero(inner[:-2] & ~inner[1:-1])
    ends = np.flatnonzero(~inner[1:-1] & inner[2:]) + 1
    up, down = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    return starts, _mixed((sums[ends] - sums[starts]) * down[starts])


def exploded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of all words of the texts, in order."""
    starts, hashes = _word_hashes(np.frombuffer(b"\n".join(texts), np.uint8))
    begins = np.cumsum([0, *[len(x) + 1 for x in texts[:-1]]])
    return hashes, np.searchsorted(begins, starts, "right") - 1


def longer(words: np.ndarray, numbers: np.ndarray, shorter: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place of the last word) of the n-grams of one word more than ``shorter``, which end at ``ends``."""
    fits = ends + 1 < len(words)
    fits[fits] = numbers[ends[fits] + 1] == numbers[ends[fits]]
    last = ends[fits] + 1
    u, v = shorter[fits], words[last]
    return _mixed(u * np.uint64(0xC2B2AE3D27D4EB4F) + (v ^ (v >> np.uint64(31))) * np.uint64(0x165667B19E3779F9)), last


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values in order, the place of each value among them, and their counts."""
    order = np.argsort(values)
    ordered = values[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    begin = np.flatnonzero(new)
    place = np.empty(len(values), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return ordered[begin], place, np.diff(np.append(begin, len(values)))


def _steps(texts: Iterable[str | None], documents: np.ndarray | None = None) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first, texts) for ``STEP`` bytes at a time; texts of a document, which follow each other, stay together."""
    first, size, held = 0, 0, []
    for n, t in enumerate(texts):
        if size >= STEP and (documents is None or documents[n] != documents[n - 1]):
            yield first, held
            first, size, held = n, 0, []
        held.append((t or "").lower().encode())
        size += len(held[-1]) + 1
    if held:
        yield first, held


def _grams(texts: list[bytes], order: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The text number of each word, and per order (hash, place of the last word) of the n-grams."""
    with np.errstate(over="ignore"):
        words, numbers = exploded(texts)
        grams = [(words, np.arange(len(words)))]
        for _ in range(order - 1):
            grams.append(longer(words, numbers, *grams[-1]))
    return numbers, grams


def _ranges(texts: Iterable[str | None], order: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The block's distinct n-grams in order and their counts, for one value of the first ``bits`` bits after the other.

    The hashes of the block are held once; what sorting and counting need besides is
    that of a range.
    """
    runs, n_words = [], 0
    for _, held in _steps(texts):
        _, grams = _grams(held, order)
        n_words += len(grams[0][0])
        runs.append(np.concatenate([h for h, _ in grams]))
        runs[-1].sort()
    bounds = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
    cuts = [[0, *np.searchsorted(r, bounds).tolist(), len(r)] for r in runs]
    for i in range(1 << bits):
        total = np.array([TOTAL] if i == 0 else [], np.uint64)
        ordered = np.concatenate([total, *[r[c[i] : c[i + 1]] for r, c in zip(runs, cuts)]])
        ordered.sort()
        begin = np.flatnonzero(np.concatenate([np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1]]))
        counts = np.diff(np.append(begin, len(ordered))).astype(np.int32)
        if i == 0:
            counts[0] = n_words
        yield ordered[begin], counts


def _entries(texts: Iterable[str | None], order: int) -> tuple[np.ndarray, np.ndarray]:
    """All distinct n-grams of the block in order, and their counts."""
    keys, counts = zip(*_ranges(texts, order, RANGE_BITS))
    return np.concatenate(keys), np.concatenate(counts)


def _places(keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where the hashes stand among the keys; looked up in order, so that neighbours share memory."""
    order = np.argsort(hashes)
    place = np.empty(len(hashes), np.int64)
    place[order] = np.searchsorted(keys, hashes[order])
    return place


# ------------------------------------------------------------------- buckets
def _binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A column of bytes, cut at ``ends``."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data).view(np.uint8))])


def _bytes(table: pa.Table, name: str) -> np.ndarray:
    """All bytes of a column."""
    column = table.column(name).cast(pa.binary()).combine_chunks()
    data = [np.zeros(0, np.uint8)]
    for c in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        _, offsets, values = c.buffers()
        offsets = np.frombuffer(offsets, np.int32)[c.offset : c.offset + len(c) + 1]
        data.append(np.frombuffer(values or b"", np.uint8)[offsets[0] : offsets[-1]])
    return np.concatenate(data)


def _squeezed(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A column of bytes, cut at ``ends``; values of ``SQUEEZED`` bytes or more are compressed."""
    values = [data[i:j].tobytes() for i, j in zip(np.append(0, ends), ends)]
    return pa.array([x if len(x) < SQUEEZED else pa.compress(x, codec="zstd", asbytes=True) for x in values], pa.binary())


def _unsqueezed(table: pa.Table, name: str) -> np.ndarray:
    """All bytes of a squeezed column whose values have the sizes in column ``n``."""
    out = [np.zeros(0, np.uint8)]
    for x, n in zip(table.column(name), table.column("n").to_pylist()):
        out.append(np.frombuffer(x.as_buffer() if n < SQUEEZED else pa.decompress(x.as_buffer(), n, codec="zstd"), np.uint8))
    return np.concatenate(out)


def _packed(counts: np.ndarray, ends: np.ndarray) -> dict[str, pa.Array]:
    """Counts as one byte each; 255 stands for the next of the large ones, which follow apart."""
    large = counts >= 255
    before = np.concatenate([[0], np.cumsum(large)])
    return {
        "n": pa.array(np.diff(ends, prepend=0).astype(np.int32)),
        "counts": _squeezed(np.minimum(counts, 255).astype(np.uint8), ends),
        "large": _binaries(counts[large].astype(np.int64), before[ends] * 8),
    }


def _unpacked(table: pa.Table) -> np.ndarray:
    """All counts of the rows."""
    small = _unsqueezed(table, "counts")
    counts = small.astype(np.int64)
    counts[small == 255] = _bytes(table, "large").view(np.int64)
    return counts


def _packed_keys(keys: np.ndarray, begin: np.ndarray, low: np.ndarray) -> dict[str, pa.Array]:
    """Sorted keys as gaps to the one before, from the bucket's bound on.

    A gap is five bytes and a sixth apart, which is small and squeezed; if one needs
    more, all are eight bytes and the rows are ``wide``.
    """
    gaps = np.diff(keys, prepend=np.uint64(0))
    gaps[begin] = keys[begin] - low
    ends = np.append(begin[1:], len(keys))
    wide = int(gaps.max()) >> 48 > 0
    columns = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)
    width = 8 if wide else 5
    return {
        "wide": pa.array(np.full(len(begin), wide)),
        "keys": _binaries(columns[:, :width].ravel(), ends * width),
        "sixth": pa.array([b""] * len(begin), pa.binary()) if wide else _squeezed(columns[:, 5], ends),
    }


def _unpacked_keys(rows: pa.Table, low: np.ndarray) -> np.ndarray:
    """The keys of rows that are all wide or all not; every row starts anew at its ``low``."""
    if not rows.num_rows:
        return np.zeros(0, np.uint64)
    sizes = rows.column("n").to_numpy().astype(np.int64)
    columns = np.zeros((int(sizes.sum()), 8), np.uint8)
    if rows.column("wide")[0].as_py():
        columns[:] = _bytes(rows, "keys").reshape(-1, 8)
    else:
        columns[:, :5] = _bytes(rows, "keys").reshape(-1, 5)
        columns[:, 5] = _unsqueezed(rows, "sixth")
    gaps = columns.view("<u8").ravel().astype(np.uint64)
    with np.errstate(over="ignore"):
        sums = np.cumsum(gaps, dtype=np.uint64)
        begin = np.cumsum(sizes) - sizes
        return sums + np.repeat(low - (sums[begin] - gaps[begin]), sizes)


def _texts(table: pa.Table, rows: np.ndarray | None = None) -> Iterator[str | None]:
    """The texts one by one, so that only a step of them is held as strings."""
    column = table.column("text")
    return (column[i].as_py() for i in (range(len(column)) if rows is None else rows.tolist()))


def _low(bucket: np.ndarray, bits: int) -> np.ndarray:
    """Least key of a bucket, which is the first ``bits`` bits of the hash."""
    return bucket.astype(np.uint64) << np.uint64(64 - bits) if bits else np.zeros(len(bucket), np.uint64)


_ASKED = "bucket int, block int, wide boolean, keys binary, sixth binary, n int, counts binary, large binary"
_ANSWERED = "bucket int, block int, n int, counts binary, large binary"


def _ask(table: pa.Table, bits: int, order: int) -> pa.Table:
    """What a block sends to each bucket."""
    block = table.column("block")[0].as_py()
    asked = []
    for keys, counts in _ranges(_texts(table), order, min(bits, RANGE_BITS)):
        if not len(keys):
            continue
        bucket = keys >> np.uint64(64 - bits) if bits else np.zeros(len(keys), np.uint64)
        begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        some = bucket[begin]
        asked.append(
            pa.table(
                {
                    "bucket": pa.array(some.astype(np.int32)),
                    "block": pa.array(np.full(len(some), block, np.int32)),
                    **_packed_keys(keys, begin, _low(some, bits)),
                    **_packed(counts, np.append(begin[1:], len(keys))),
                }
            )
        )
    return pa.concat_tables(asked)


def _answer(table: pa.Table, bits: int) -> pa.Table:
    """What the other blocks count, to each block in the order it asked."""
    table = table.sort_by("wide")
    counts, low = _unpacked(table), _low(table.column("bucket").to_numpy(), bits)
    narrow = table.num_rows - int(np.count_nonzero(table.column("wide").to_numpy()))
    every = np.concatenate([_unpacked_keys(table.slice(0, narrow), low[:narrow]), _unpacked_keys(table.slice(narrow), low[narrow:])])
    distinct, place, _ = _distinct(every)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, place, counts)
    ends = np.cumsum(table.column("n").to_numpy().astype(np.int64))
    return pa.table({"bucket": table.column("bucket"), "block": table.column("block"), **_packed(sums[place] - counts, ends)})


_SCORED = "doc_id long, n_words long, n_seen long, n_longest long, score double"


def _score(block: pa.Table, answers: pa.Table, backoff: float, order: int) -> pa.Table:
    """Scores of a block's documents from the corpus counts of its n-grams."""
    keys, counts = _entries(_texts(block), order)
    totals = _unpacked(answers.sort_by("bucket"))
    if len(totals) != len(keys):
        raise RuntimeError("a block's answers do not fit its n-grams")
    totals += counts
    del counts
    n_all = math.log(max(int(totals[0]), 1))
    # Rows equal in id and text are one document.
    k = block.column("k").to_numpy()
    rows = np.argsort(k, kind="stable")
    documents = k[rows]
    size, n_pairs, n_longest = (np.zeros(len(rows), np.int64) for _ in range(3))
    total = np.zeros(len(rows))
    for first, held in _steps(_texts(block, rows), documents):
        number, grams = _grams(held, order)
        own_rows = slice(first, first + len(held))
        _, document = np.unique(documents[own_rows], return_inverse=True)
        place = np.split(_places(keys, np.concatenate([h for h, _ in grams])), np.cumsum([len(h) for h, _ in grams])[:-1])
        context = np.log(np.maximum(totals[place[0]], 1))
        gain = context - n_all
        for words, (key, (_, last)) in enumerate(zip(place[1:], grams[1:]), 2):
            _, same, own = _distinct(document[number[last]] * np.int64(len(keys)) + key) if len(key) else (key, key, key)
            others = totals[key] - own[same]
            seen = others > 0
            found = np.log(np.maximum(others, 1))
            gain[last] = np.where(seen, found - context[last - 1], math.log(backoff) + gain[last])
            context = np.zeros(len(number))
            context[last] = found
            n_seen = np.bincount(number[last], weights=seen, minlength=len(held)).astype(np.int64)
            for which, column in ((2, n_pairs), (order, n_longest)):
                if words == which:
                    column[own_rows] = n_seen
        size[own_rows] = np.bincount(number, minlength=len(held))
        total[own_rows] = np.bincount(number, weights=gain, minlength=len(held))
    return pa.table(
        {
            "doc_id": block.column("doc_id").take(pa.array(rows)),
            "n_words": pa.array(size),
            "n_seen": pa.array(n_pairs),
            "n_longest": pa.array(n_longest),
            "score": pa.array(total / np.maximum(size, 1), mask=size == 0),
        }
    )


def score(docs: DataFrame, backoff: float = BACKOFF, order: int = ORDER, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_words, n_seen, n_longest, score) per row of ``docs`` (doc_id, text).

    ``n_seen`` is the number of pairs found elsewhere in the corpus, ``n_longest`` that
    of n-grams of ``order`` words, ``score`` the mean natural logarithm per word.
    """
    if order < 1:
        raise ValueError("order is the number of words of the longest n-gram, one at least")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    bits = max(0, -(-size * order // bucket_bytes) - 1).bit_length()
    k = F.xxhash64("doc_id", "text")
    dealt = docs.select(F.pmod(F.xxhash64(k, F.lit("block")), F.lit(n)).cast("int").alias("block"), F.col("doc_id").cast("long").alias("doc_id"), k.alias("k"), "text").repartition("block")
    asked = dealt.groupBy("block").applyInArrow(lambda t: _ask(t, bits, order), _ASKED)
    answers = asked.groupBy("bucket").applyInArrow(lambda t: _answer(t, bits), _ANSWERED)
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lambda b, a: _score(b, a, backoff, order), _SCORED)
