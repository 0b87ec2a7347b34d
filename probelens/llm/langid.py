"""Language identification by compression.

Each language has a zstandard raw-content dictionary: whole texts of a bounded
sample of its labelled rows. A text is encoded once with every dictionary; the
language whose dictionary gives the smallest encoding wins, and the margin over
the runner-up says how sure that is. Texts are lower-cased and reduced to their
letters (markup, digits and capitals say little about the language) and encoded
in chunks of ``CHUNK`` bytes, all of them, so that a long text keeps being
measured against the dictionary instead of its own beginning. If two languages
tie, as they do for one word repeated over and over, the distinct words decide.

Learning reads labelled rows only. The sample of a language is the rows whose
id hash falls below a threshold set from the language's row count, so choosing
it is a map over the rows; its bounds are ``SAMPLE_ROWS`` rows in expectation
and ``DICT_BYTES`` bytes. Dictionaries are the only thing the driver holds; their number is the
number of languages, at most ``MAX_LANGUAGES``.

Defined cases: a null text or one without a letter is ``und`` with score 0 and
not accepted; with no labelled row every text is ``und``; with one language the
score is 1 for every text that has a letter; equal sizes go to the first
language by code point with score 0. Input columns named as result columns are
replaced by them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import zstandard as zstd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from probelens.llm.common import ship, without

ship(__name__)

UNKNOWN = "und"
RESULT = ("lang_pred", "score", "accepted")
#: Fit bounds: labelled rows (expected) and dictionary bytes per language.
SAMPLE_ROWS, DICT_BYTES = 400, 262_144
MAX_LANGUAGES = 512
CHUNK, LEVEL = 4096, 5
#: Least relative margin between the two smallest encodings.
MARGIN = 0.01
_NO_LETTERS = re.compile(r"[\W\d_]+")


def fit(labelled: DataFrame, key: Column, sample_rows: int = SAMPLE_ROWS, dict_bytes: int = DICT_BYTES) -> dict[str, bytes]:
    """A dictionary per language from rows (text, lang); ``key`` spreads the rows for sampling."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    out: dict[str, bytes] = {}
    if not sizes:
        return out
    draw = F.shiftrightunsigned(F.xxhash64(key), 1)
    spread = float(1 << 63)
    wanted = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, sample_rows / n))) for k, n in sizes.items()])
    picked = rows.where(draw / F.lit(spread) < wanted).select("lang", "text", draw.alias("draw"), F.octet_length("text").alias("bytes"))
    order = Window.partitionBy("lang").orderBy("draw", "text")
    fits = F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, -1))
    bounded = picked.withColumn("before", F.coalesce(fits, F.lit(0))).where(F.col("before") < dict_bytes)
    texts: dict[str, list[bytes]] = {k: [] for k in sizes}
    for r in bounded.orderBy("lang", "draw", "text").select("lang", "text").toLocalIterator():
        texts[r["lang"]].append(normalised(r["text"]))
    for k, parts in texts.items():
        # A dictionary too small to hold a match is no dictionary to zstandard.
        out[k] = b"\n".join(parts)[:dict_bytes].ljust(8, b"\n")
    return out


def normalised(text: str) -> bytes:
    """The lower-case letters of a text, one space between runs of them and around."""
    return f" {_NO_LETTERS.sub(' ', text).strip().lower()} ".encode()


def _encoders(dictionaries: dict[str, bytes], level: int) -> list[tuple[str, zstd.ZstdCompressor]]:
    made = []
    for lang in sorted(dictionaries, key=lambda k: k.encode()):
        content = zstd.ZstdCompressionDict(dictionaries[lang], dict_type=zstd.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=level)
        made.append((lang, zstd.ZstdCompressor(dict_data=content, write_content_size=False, write_dict_id=False)))
    return made


def _sizes(raw: bytes, encoders: list[tuple[str, zstd.ZstdCompressor]], chunk: int) -> list[tuple[int, int]]:
    pieces = [raw[at : at + chunk] for at in range(0, len(raw), chunk)]
    return sorted((sum(len(e.compress(p)) for p in pieces), n) for n, (_, e) in enumerate(encoders))


def classify(text: str | None, encoders: list[tuple[str, zstd.ZstdCompressor]], chunk: int = CHUNK) -> tuple[str, float]:
    """(language, margin) of one text."""
    if not text or not encoders or not (raw := normalised(text)).strip():
        return UNKNOWN, 0.0
    sizes = _sizes(raw, encoders, chunk)
    if len(sizes) == 1:
        return encoders[0][0], 1.0
    if sizes[0][0] == sizes[1][0]:
        sizes = _sizes(b" %b " % b" ".join(dict.fromkeys(raw.split())), encoders, chunk)
    best, runner_up = sizes[0], sizes[1]
    return encoders[best[1]][0], (runner_up[0] - best[0]) / runner_up[0]


def _classified(batches: Iterator[pd.Series], dictionaries, level: int, chunk: int) -> Iterator[pd.DataFrame]:
    encoders = _encoders(dictionaries.value, level)
    for texts in batches:
        yield pd.DataFrame([classify(t, encoders, chunk) for t in texts], columns=["lang", "score"])


def identify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN, level: int = LEVEL, chunk: int = CHUNK) -> DataFrame:
    """``docs`` with lang_pred, score (relative margin) and accepted (margin not narrow)."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    @F.pandas_udf("lang string, score double")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from _classified(batches, shared, level, chunk)

    guessed = without(docs, *RESULT).withColumn("__lang", guess(F.col("text")))
    lang, score = F.col("__lang.lang"), F.col("__lang.score")
    return guessed.withColumns({"lang_pred": lang, "score": score, "accepted": (lang != UNKNOWN) & (score >= margin)}).drop("__lang")
