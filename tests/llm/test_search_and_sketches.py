"""Centroids, ranked search and sketches against brute force."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
import struct
import sys
from collections import Counter

import numpy as np
import pytest
import xxhash

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402
import edge  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from probelens.llm import bottom_k, catalog, centroids, lexical_search  # noqa: E402

SMALL = "/root/testdata/sf0.001"


# -------------------------------------------------------------- centroids
def brute_clusters(rows, k=40, rounds=5):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    place = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centers = [v for _, v in sorted(kept, key=place)[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    assign = lambda: [min((far(v, c), n) for n, c in enumerate(centers)) for _, v in kept]
    for _ in range(rounds):
        found = assign()
        for n in range(len(centers)):
            mine = [v for (_, v), (_, c) in zip(kept, found) if c == n]
            if mine:
                centers[n] = [sum(x) // len(mine) for x in zip(*mine)]
    found, inertia = assign(), Counter()
    for d, c in found:
        inertia[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return [(i, c, d, inertia[c], sum(inertia.values()), digest[c]) for (i, _), (d, c) in zip(kept, found)]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"cluster": F.lit("x"), "planes": F.lit(1), "id": F.lit(None), "v": F.lit("y")})


def test_clusters(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice((-1, 1)) * (i % 3) + rng.gauss(0, 0.5) for _ in range(64)]) for i in range(300)]
    odd = [(300, None), (301, []), (302, [0.5] * 63), (303, [0.5] * 63 + [None]), (304, [0.5] * 63 + [float("nan")]), (305, [0.5] * 63 + [float("-inf")])]
    again = [(7, rows[7][1]), (7, rows[9][1]), (None, rows[3][1]), (None, [0.0] * 64)]
    for case in (rows + odd + again, rows[:3] + odd, [(1, [0.0] * 64)] * 3, [(1, [-1.0] * 64), (2, [300.0] * 64)]):
        case = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in case]
        got = [tuple(r) for r in centroids.cluster(vectors(spark, case)).collect()]
        assert Counter(got) == Counter(brute_clusters(case))


def test_no_vectors_and_values_too_large(spark):
    for rows in ([], [(1, None)]):
        assert centroids.cluster(vectors(spark, rows)).collect() == []
    with pytest.raises(ValueError, match="64 bits"):
        centroids.cluster(vectors(spark, [(1, [1e30] * 64)]))


@pytest.mark.parametrize("bits", [1, 2, 9, 28])
def test_planes_give_exact_products(bits):
    rng = np.random.default_rng(bits)
    low, high = -(1 << (bits - 1)), (1 << (bits - 1)) - 1
    x, c = rng.integers(low, high + 1, (50, 64)), rng.integers(low, high + 1, (7, 64))
    x[0], c[0] = low, low
    assert (centroids.unpack(centroids.pack(x, bits)) == x).all()
    assert (centroids.dots(centroids.pack(x, bits), centroids.pack(c, bits)) == x @ c.T).all()


# ------------------------------------------------------------------ search
def terms(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute_search(docs, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, total, out = len(held), sum(sum(c.values()) for _, c in held), []
    df = Counter(t for _, c in held for t in c)
    for item_id, text in set(items):
        scores = []
        for doc_id, c in held:
            m = 25 + 75 * sum(c.values()) * n // total
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, q in Counter(terms(text)).items() if t in c)
            if s > 0:
                scores.append((-s, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k], 1)]
    return out


ITEMS = [(1, "the quick brown Fox"), (1, "the quick brown Fox"), (1, "potions"), (2, None), (3, ""), (4, "... !!"), (5, "same SAME same"), (None, "漢字 🙂 mail 10"), (6, "nothing-matches zzz"), (7, edge.LONG)]


def items(spark, rows=None):
    return spark.createDataFrame(ITEMS if rows is None else rows, "item_id long, text string").withColumn("rank", F.lit("x"))


@pytest.mark.parametrize("block_terms", [10, 200_000])
def test_search(spark, block_terms):
    table = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    asked = ITEMS if block_terms > 10 else ITEMS[:9]
    copies = [(100 + i, edge.PASSAGE, "en", "a", 1) for i in range(30)]
    for rows in (edge.ROWS + copies, table + edge.ROWS):
        got = [tuple(r) for r in lexical_search.search(edge.cluttered(spark, rows), items(spark, asked), block_terms=block_terms).collect()]
        assert Counter(got) == Counter(brute_search([r[:2] for r in rows], asked))


def test_search_of_nothing(spark):
    none = edge.documents(spark, [])
    assert lexical_search.search(none, items(spark)).collect() == []
    assert lexical_search.search(edge.documents(spark), items(spark, [])).collect() == []
    assert lexical_search.search(edge.documents(spark, [(1, None, "a", "b", 0), (2, "?!", "a", "b", 2)]), items(spark)).collect() == []


def test_terms_do_not_depend_on_slices(monkeypatch):
    text = (edge.LONG[:3000] + "Ünï_漢字-x" * 50).encode()
    whole = [t for part in lexical_search.terms(text) for t in part]
    monkeypatch.setattr(lexical_search, "SLICE", 7)
    assert [t for part in lexical_search.terms(text) for t in part] == whole == [t.encode() for t in terms(text.decode())]


def test_partial_sums_stay_below_the_exact_range(monkeypatch):
    monkeypatch.setattr(lexical_search, "EXACT", 10 * 20 * lexical_search.IMPACT + 1)
    asked, weight = [{t: 1 + t % 7 for t in range(30)}, {3: 45, 4: 1}, {}], np.full(30, 20, np.int64)
    whole = np.zeros((3, 30))
    for first, wanted, counts in lexical_search.tiles(asked, weight):
        assert first == 0 and ((counts * 20 * lexical_search.IMPACT).sum(axis=1) < lexical_search.EXACT).all()
        for at, t in enumerate(wanted):
            whole[:, t] += counts[:, at]
    assert [{t: q for t, q in enumerate(row) if q} for row in whole.tolist()] == asked


def test_best_keeps_ties_by_id():
    scores, ids = np.array([5, 7, 5, 0, 5, 9, -1]), np.array([9, 4, 3, 1, 8, 2, 0])
    assert [x.tolist() for x in lexical_search.best(scores, ids, 4)] == [[9, 7, 5, 5], [2, 4, 3, 8]]
    assert [x.tolist() for x in lexical_search.best(scores, ids, 9)] == [[9, 7, 5, 5, 5], [2, 4, 3, 8, 9]]


# ---------------------------------------------------------------- sketches
def signed(n):
    return n - (1 << 64) if n >> 63 else n


def chained(values, seed=42):
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", signed(v)), seed=seed)
    return seed


def brute_sketch(text, k=128):
    ws = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in brute.words((text or "").lower())]
    if len(ws) >= 5:
        found = {signed(chained(ws[i : i + 5])) for i in range(len(ws) - 4)}
    elif ws:
        h = 42
        for w in ws:
            h = chained([h, w])
        found = {signed(h)}
    else:
        found = set()
    return sorted(found)[:k]


def likeness(a, b, k=128):
    u = sorted(set(a) | set(b))[:k]
    return len(set(u) & set(a) & set(b)) / len(u) if u else 1.0


def show(s):
    return "".join(f"{h % (1 << 64):016x}" for h in s)


def brute_fingerprints(rows):
    order = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is None, r[0] or 0, signed(xxhash.xxh64_intdigest(r[1].encode(), seed=42))))
    after = {r: order[(n + 1) % len(order)][1] for n, r in enumerate(order)}
    for i, t in rows:
        t = t or ""
        cut = len(t) // 4
        new = t[: len(t) - cut] + after[i, t][:cut]
        a, b, c = brute_sketch(t), brute_sketch(new), brute_sketch(after[i, t])
        yield i, len(t), hashlib.sha256(new.encode()).hexdigest(), show(a), show(b), round(likeness(a, b), 9), round(likeness(a, c), 9)


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def test_fingerprints(spark, tmp_path):
    table = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    for n, rows in enumerate((edge.ROWS, table, edge.ROWS[:1], [])):
        edge.cluttered(spark, rows).drop("nothing").write.parquet(f"{tmp_path}/{n}/documents.parquet")
        got = [(*r[:5], round(r[5], 9), round(r[6], 9)) for r in catalog.op13_document_fingerprints(spark, f"{tmp_path}/{n}").select(*COLUMNS).collect()]
        assert Counter(got) == Counter(brute_fingerprints([r[:2] for r in rows]))


def test_successors_do_not_depend_on_ranges(spark, monkeypatch):
    rows = [(i * 7919 % 1000, f"text {i}", "en", "a", 1) for i in range(1000)]
    for root in (lambda n: 0, lambda n: 8 * 40):
        monkeypatch.setattr(bottom_k.math, "isqrt", root)
        got = {r.doc_id: r.head for r in bottom_k.with_successor(edge.documents(spark, rows), share=1).collect()}
        by_id = sorted(rows)
        assert got == {r[0]: by_id[(n + 1) % 1000][1][: len(r[1])] for n, r in enumerate(by_id)}


def test_sketches_merge_and_estimate(spark):
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(6000)]
    text = lambda a, b: " ".join(words[a:b])
    rows = [("g", text(0, 4004)), ("g", text(4000, 6000)), ("h", text(0, 3)), ("h", None), ("k", text(0, 104))]
    df = spark.createDataFrame(rows, "g string, text string").withColumn("sketch", bottom_k.sketch(F.col("text")))
    got = {r.g: r for r in bottom_k.merged(df, ["g"]).withColumn("n", bottom_k.n_distinct(F.col("sketch"))).collect()}
    assert got["g"].sketch == brute_sketch(text(0, 6000)) and got["h"].sketch == brute_sketch(text(0, 3))
    assert abs(got["g"].n / 5996 - 1) < 0.3 and got["k"].n == 100 and got["h"].n == 1
    pair = spark.createDataFrame([(text(0, 1004), text(0, 4004)), ("", text(0, 9)), ("", None), (text(0, 60), text(20, 90))], "a string, b string")
    s, t = bottom_k.sketch(F.col("a")), bottom_k.sketch(F.col("b"))
    rows = pair.select(bottom_k.resemblance(s, t).alias("r"), bottom_k.containment(s, t).alias("c"), bottom_k.containment(t, s).alias("d")).collect()
    assert abs(rows[0].r - 0.25) < 0.12 and rows[0].c > 0.75 and abs(rows[0].d - 0.25) < 0.12
    assert (rows[1].r, rows[1].c) == (0.0, 1.0) and (rows[2].r, rows[2].c) == (1.0, 1.0)
    assert rows[3].r == pytest.approx(36 / 86) and rows[3].c == pytest.approx(36 / 56)
