r"""Quality rules with robust multivariate outliers.

Base rules reject short texts and texts made of repeated five-word windows. The
rest is judged by its statistic vector: log length, log mean word length, and
log rates of symbols, repeated lines and repeated windows. For each language and
source a minimum-covariance-determinant (MCD) estimate gives centre and scatter
of the central ``COVERED`` share of vectors, and texts whose Mahalanobis distance
from it is beyond ``CUTOFF`` are rejected.

The MCD is found by concentration steps from the coordinate-wise median and MAD:
estimate, rank all members by distance, keep the nearest share, estimate again.
Every step is two aggregations over a narrow table of integers. Statistics are
rounded to thousandths, so sums are exact and reruns agree to the last bit, and
quantiles are exact with a map of at most a few ten thousand values per group,
however many rows a group holds. A group that holds a third of all rows is
summed in every task that has some of it, and its estimate goes to its rows as a
broadcast while groups number at most ``BROADCAST_GROUPS``.

A group of fewer than ``FULL`` judged rows has too few to speak for itself. Its
estimate is mixed with that of all such small groups of its language, that one with
the estimate over all small groups, and that one with a wide scatter (``PRIOR``); each
counts for its number of rows in ``FULL``. The mixture has the mean and the covariance
of a population drawn from both, so a group unlike its pool is judged mildly, and no
row goes unjudged. Scatter gets a floor (``FLOORS``), since most clean texts have
no symbol or repeat at all and their variance would be zero.

Defined cases: a null text has no words and fails the base rules; null language
or source forms groups of its own; rows are judged one by one, so repeated rows
agree; an empty table gives an empty result. Input columns named as result
columns are replaced by them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probelens.llm.common import HAS_WORD, let, lines, staged, without, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Half of a group, the least that may be covered: any smaller group of junk or copies can be left out.
COVERED, STEPS = 0.5, 6
#: Judged rows from which a group or pool counts in full.
FULL = 30
#: Groups whose estimates (20 doubles each, 4 MB in all) may be broadcast; more are joined by shuffle.
BROADCAST_GROUPS = 20_000
#: Least standard deviation of each statistic, in thousandths of a log unit, before the consistency
#: factor; with it they are 119, 59 and 595.
FLOORS = (86, 43, 430, 430, 430)
#: Standard deviation of each statistic, in the same unit, where no rows tell.
PRIOR = (1000, 250, 1500, 1500, 1500)
#: Square of the distance that one in a thousand normal vectors exceeds (chi-square, 5 degrees).
CUTOFF = 20.5
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_DIM = range(len(FLOORS))
_LOWER = [(i, j) for i in _DIM for j in range(i + 1)]
_MEANS = [f"m{i}" for i in _DIM]
_COVARIANCES = [f"c{i}{j}" for i, j in _LOWER]
#: Names the pool of all small groups.
REST = "rest"


# --------------------------------------------------------------- statistics
def _repeated_words(ws: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that occur twice or more."""
    n = F.size(ws)
    starts = F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW)).otherwise(F.array().cast("array<int>"))
    hashed = F.transform(ws, lambda w: F.xxhash64(w))
    windows = let(hashed, lambda h: F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])))

    def covered(at: Column) -> Column:
        step = F.transform(at, lambda x, k: F.least(F.coalesce(F.get(at, k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(step, F.lit(0), lambda a, b: a + b)

    def repeated_at(s: Column) -> Column:
        same = lambda e, other: F.coalesce(other["h"] == e["h"], F.lit(False))
        marked = F.transform(s, lambda e, k: F.when(same(e, F.get(s, k - 1)) | same(e, F.get(s, k + 1)), e["i"]))
        return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))

    def counted(g: Column) -> Column:
        ordered = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        found = let(let(ordered, repeated_at), covered)
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(found)

    return let(windows, counted)


def statistics(text: Column) -> Column:
    """A struct of ``STATS``, all long."""
    safe = F.coalesce(text, F.lit(""))
    bare = safe
    for symbol in SYMBOLS:
        bare = F.replace(bare, F.lit(symbol), F.lit(""))
    n_symbols = F.length(safe) - F.length(bare)
    spoken = F.filter(lines(text), lambda x: x.rlike(HAS_WORD))
    n_dup = let(spoken, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    by_word = let(words(text), lambda w: F.struct(F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("c"), _repeated_words(w).alias("r")))
    both = let(by_word, lambda x: F.struct(x["n"].cast("long").alias("n_words"), x["c"].cast("long").alias("word_chars"), x["r"].cast("long").alias("n_repeat_words")))
    return F.struct(both.alias("w"), n_symbols.cast("long").alias("n_symbols"), n_dup.cast("long").alias("n_dup_lines"))


def _vector() -> list[Column]:
    """The transformed statistics in thousandths."""
    per_hundred = lambda c, of: F.log1p(F.col(c) * 100 / F.col(of))
    raw = (
        F.log1p("n_words"),
        F.log(F.col("word_chars") / F.col("n_words")),
        per_hundred("n_symbols", "word_chars"),
        per_hundred("n_dup_lines", "n_words"),
        per_hundred("n_repeat_words", "n_words"),
    )
    return [F.round(c * 1000).cast("long") for c in raw]


# ---------------------------------------------------------------------- MCD
def consistency(covered: float = COVERED) -> float:
    """What the covered share's scatter is multiplied by to fit normal vectors of 5 dimensions."""

    def below(x: float, seven: bool) -> float:
        tail = math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
        return math.erf(math.sqrt(x / 2)) - tail * (1 + x / 3 + (x * x / 15 if seven else 0))

    low, high = 0.0, 100.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid, False) < covered else (low, mid)
    return covered / below(low, True)


def _gid(level: int, *names: str) -> Column:
    return F.to_json(F.struct(F.lit(level).alias("level"), *[F.col(n) for n in names]))


def _beside(per_group: DataFrame) -> DataFrame:
    """The per-group table, broadcast if its size allows: a hot group's rows then stay where they are."""
    small = per_group.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    return F.broadcast(per_group) if small else per_group


def _kept(per_group: DataFrame) -> DataFrame:
    """A table with one row per group, written as one file."""
    return staged(per_group.repartition(1))


def _distance(factor: float = 1.0) -> Column:
    """Squared Mahalanobis distance from the centre m* under the inverse factor w**."""
    total = F.lit(0.0)
    for i in _DIM:
        y = F.lit(0.0)
        for j in range(i + 1):
            y = y + F.col(f"w{i}{j}") * (F.col(f"x{j}") - F.col(f"m{j}"))
        total = total + y * y
    return total / F.lit(factor)


def _start(rows: DataFrame) -> DataFrame:
    """Per group: medians, and one over the MAD (at least the floor) on the diagonal."""
    medians = rows.groupBy("gid").agg(*[F.percentile(f"x{i}", F.lit(0.5)).alias(f"m{i}") for i in _DIM])
    spread = rows.join(medians, "gid").groupBy("gid").agg(*[F.percentile(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), F.lit(0.5)).alias(f"d{i}") for i in _DIM])
    scale = lambda i: F.greatest(F.col(f"d{i}") * 1.4826, F.lit(float(FLOORS[i])))
    weights = [(1 / scale(i) if i == j else F.lit(0.0)).alias(f"w{i}{j}") for i, j in _LOWER]
    return medians.join(spread, "gid").select("gid", *[f"m{i}" for i in _DIM], *weights)


def _estimate(rows: DataFrame) -> DataFrame:
    """Per group of rows (gid, n, x0 to x4): n, means and the floored covariance."""
    sums = rows.groupBy("gid").agg(F.first("n").alias("n"), F.count("*").alias("held"), *[F.sum(f"x{i}").alias(f"s{i}") for i in _DIM], *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i, j in _LOWER])
    out = sums.withColumns({f"m{i}": F.col(f"s{i}") / F.col("held") for i in _DIM})

    def covariance(i: int, j: int) -> Column:
        cov = F.col(f"s{i}{j}") / F.col("held") - F.col(f"m{i}") * F.col(f"m{j}")
        return F.greatest(cov, F.lit(0.0)) + F.lit(float(FLOORS[i] ** 2)) if i == j else cov

    return out.select("gid", "n", *_MEANS, *[covariance(i, j).alias(f"c{i}{j}") for i, j in _LOWER])


def _inverted(out: DataFrame) -> DataFrame:
    """Adds the inverse Cholesky factor of the covariance."""
    for i, j in _LOWER:
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1.0))) if i == j else rest / F.col(f"l{j}{j}"))
    for i, j in _LOWER:
        rest = F.lit(1.0) if i == j else F.lit(0.0)
        for k in range(j, i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"w{k}{j}")
        out = out.withColumn(f"w{i}{j}", rest / F.col(f"l{i}{i}"))
    return out.drop(*[f"l{i}{j}" for i, j in _LOWER])


def mcd(rows: DataFrame, steps: int = STEPS, covered: float = COVERED) -> DataFrame:
    """Robust estimate per ``gid`` of rows (gid, x0 to x4): n, centre m*, covariance c** of the covered share."""
    beside = _beside(_kept(_start(rows)))
    rank = F.floor(F.log(_distance() + F.lit(1e-6)) * 64).cast("long")
    for _ in range(steps):
        ranked = rows.join(beside, "gid").select("gid", *[f"x{i}" for i in _DIM], rank.alias("rank"))
        limit = ranked.groupBy("gid").agg(F.percentile("rank", F.lit(covered)).alias("limit"), F.count("*").alias("n"))
        now = _kept(_inverted(_estimate(ranked.join(_beside(limit), "gid").where("rank <= limit"))))
        beside = _beside(now.select("gid", *_MEANS, *[f"w{i}{j}" for i, j in _LOWER]))
    return now.select("gid", "n", *_MEANS, *_COVARIANCES)


def _mixed(own: DataFrame, pool: DataFrame) -> DataFrame:
    """``own`` (gid, n, up, m*, c**) mixed with the estimate of its pool, ``up``."""
    share = F.least(F.col("n") / FULL, F.lit(1.0))
    both = own.join(pool.select(F.col("gid").alias("up"), *[F.col(c).alias(f"p{c}") for c in (*_MEANS, *_COVARIANCES)]), "up")
    apart = {i: F.col(f"m{i}") - F.col(f"pm{i}") for i in _DIM}
    means = [(share * F.col(m) + (1 - share) * F.col(f"p{m}")).alias(m) for m in _MEANS]
    within = {f"c{i}{j}": share * F.col(f"c{i}{j}") + (1 - share) * F.col(f"pc{i}{j}") for i, j in _LOWER}
    return both.select("gid", *means, *[(within[f"c{i}{j}"] + share * (1 - share) * apart[i] * apart[j]).alias(f"c{i}{j}") for i, j in _LOWER])


def fitted(rows: DataFrame) -> DataFrame:
    """What judges each group of rows (gid, lang, source, x0 to x4): centre m* and inverse factor w**."""
    vector = [f"x{i}" for i in _DIM]
    sizes = _kept(rows.groupBy("gid", "lang").agg(F.count("*").alias("n")))
    small = sizes.where(F.col("n") < FULL).select("gid", _gid(1, "lang").alias("pool"))
    lone = rows.select("gid", *vector).join(_beside(small), "gid")
    pooled = lone.select(F.explode(F.array("pool", F.lit(REST))).alias("gid"), *vector)
    found = staged(mcd(rows.select("gid", *vector).unionByName(pooled)).repartition(1))

    share = F.least(F.col("n") / FULL, F.lit(1.0))
    wide = {f"c{i}{i}": share * F.col(f"c{i}{i}") + (1 - share) * F.lit(PRIOR[i] ** 2 / consistency()) for i in _DIM}
    narrow = {f"c{i}{j}": share * F.col(f"c{i}{j}") for i, j in _LOWER if i != j}
    rest = found.where(F.col("gid") == REST).withColumns(wide | narrow)
    of_language = _mixed(found.join(small.select(F.col("pool").alias("gid")).distinct(), "gid").withColumn("up", F.lit(REST)), rest)
    of_small = _mixed(found.join(small.withColumnRenamed("pool", "up"), "gid"), of_language)
    full = found.join(sizes.where(F.col("n") >= FULL).select("gid"), "gid").select(of_small.columns)
    return _kept(_inverted(full.unionByName(of_small)).select("gid", *_MEANS, *[f"w{i}{j}" for i, j in _LOWER]))


def judge(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang, source): ``STATS``, base_failed, distance, kept.

    ``distance`` is the squared robust distance, null where the base rules fail.
    """
    found = docs.select("doc_id", "lang", "source", statistics(F.col("text")).alias("s"))
    flat = found.select("doc_id", "lang", "source", "s.w.n_words", "s.w.word_chars", "s.n_symbols", "s.n_dup_lines", "s.w.n_repeat_words")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    table = staged(flat.withColumn("base_failed", failed))
    judged = table.where(~F.col("base_failed")).select("*", *[c.alias(f"x{i}") for i, c in enumerate(_vector())])
    rows = staged(judged.withColumn("gid", _gid(0, "lang", "source")))
    scored = rows.join(_beside(fitted(rows)), "gid").withColumn("distance", _distance(consistency()))
    shown = ["doc_id", "lang", "source", *STATS, "base_failed", "distance"]
    every = scored.select(*shown).unionByName(table.where("base_failed").withColumn("distance", F.lit(None).cast("double")).select(*shown))
    return every.withColumn("kept", ~F.col("base_failed") & (F.col("distance") <= CUTOFF))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns; ids decide, so rows that share an id pass or fail together."""
    bad = judge(docs).where(~F.col("kept")).select(F.col("doc_id").alias("__bad")).distinct()
    clean = without(docs, "__bad")
    return clean.join(staged(bad), clean["doc_id"].eqNullSafe(F.col("__bad")), "left_anti")
