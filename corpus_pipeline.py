"""The corpus pipeline: documents in, the training mix out.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and reread as the next one's
``docs``. All stages but the last return the columns of ``documents``. Texts that a
stage changes get a new ``n_chars``. Each stage calls one operator of
``probelens.llm`` with the parameters of its registered query, on all that its
predecessor kept; see the operators for nulls, ties, repeats and empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probelens.llm import decontaminate, langid, line_dedup, mixing, simhash
from probelens.llm.common import set_aside, staged


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language can't be told (no letter, or a narrow margin)."""
    dictionaries = langid.fit(docs.select("doc_id", "text", "lang"), F.col("doc_id"))
    rest, columns = set_aside(docs, langid.RESULT)
    return langid.identify(rest, dictionaries).where("accepted").select(*columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that stand on over a fiftieth of their source's pages, five at least."""
    rest, columns = set_aside(docs, line_dedup.RESULT)
    cleaned = line_dedup.drop_boilerplate(rest)
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", n_chars).select(*columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with how often each is taken."""
    return mixing.mix_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]

#: Compression sizes and XXH64 have no SQL form; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
