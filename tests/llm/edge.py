"""Small tables with the awkward cases that every operator has to define."""

from __future__ import annotations

LONG = " ".join(f"word{i} next{i % 7} and" for i in range(9000))
PASSAGE = "the quick brown fox jumps over the lazy dog while seven wizards mix strong potions in a deep well at noon"
ROWS = [
    (1, "Ein kleiner Text mit dem und der und die Wörter für alle", "de", "a", 10),
    (2, None, "de", "a", None),
    (3, "", "en", None, 0),
    (4, " \t\n ", None, "b", 4),
    (5, LONG, "en", "a", len(LONG)),
    (6, PASSAGE, "en", "b", len(PASSAGE)),
    (7, PASSAGE, "en", "b", len(PASSAGE)),
    (7, PASSAGE, "en", "b", len(PASSAGE)),
    (8, "before it " + PASSAGE + " and after it", "en", "b", 1),
    (8, "other text with the same id " + PASSAGE, "en", "c", 1),
    (None, PASSAGE + " without an id", "en", "c", 1),
    (None, "noch ein Text ohne Nummer", None, None, None),
    (9, "ünïcödé 漢字 🙂 mail a.b+c@ex-ample.co.uk or 10.0.0.255 and +49 (30) 123-4567, card 4111 1111 1111 1111", "en", "a", 1),
    (10, "same same same same same same same same same same same same", "en", "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows=None):
    return spark.createDataFrame(ROWS if rows is None else rows, SCHEMA)


def cluttered(spark, rows=None):
    """The same rows with extra columns whose names clash with results and helpers."""
    from pyspark.sql import functions as F

    df = documents(spark, rows)
    names = ["Size", "taken", "copies", "TARGET", "score", "lang_pred", "accepted", "n_lines", "n_dropped", "n_words", "kept", "spans", "fp", "component_id", "text_hash", "item_id", "weight", "id", "owner", "k", "w", "host", "page", "line"]
    return df.select("*", *[F.lit("x").alias(n) for n in names], F.create_map(F.lit("k"), F.lit(1)).alias("m"), F.lit(None).alias("nothing"))
