"""Registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probelens.llm import bottom_k, centroids, decontaminate, html_extract, langid, lexical_search, line_dedup, lm_scoring, mixing, pii, quality, simhash, suffix_dedup


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of every document; pairs are judged by the rest of the corpus."""
    return lm_scoring.score(_documents(spark, sf_dir)).withColumn("score", F.round("score", 6))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted fair queueing of all documents over their sources (weights 5, 2, 1)."""
    return mixing.mix(_documents(spark, sf_dir)).select("doc_id", "source", "size", "source_size", "weight", "target", "copies", "taken")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and robust outliers per language and source."""
    return quality.judge(_documents(spark, sf_dir)).select("doc_id", *quality.STATS, "base_failed", "kept", "distance")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat 50 bytes of an earlier one, removed."""
    docs = _documents(spark, sf_dir)
    size, digest = F.col("n_bytes"), F.sha2(F.col("kept"), 256)
    n_removed, n_spans = size - F.octet_length("kept"), F.size("spans").cast("long")
    found = suffix_dedup.by_text(docs).select("id", "id2", "owner", "n_bytes", n_removed.alias("n_removed"), n_spans.alias("n_spans"), digest.alias("kept_sha256"))
    nothing = F.sha2(F.lit(b""), 256)
    whole = {"n_bytes": F.col("__n_bytes"), "n_removed": F.col("__n_bytes"), "n_spans": F.lit(1).cast("long"), "kept_sha256": nothing}
    rows = suffix_dedup.of_documents(docs.select("doc_id", "text"), found, whole)
    zero = F.lit(0).cast("long")
    return rows.select("doc_id", *[F.coalesce(c, zero).alias(c) for c in ("n_bytes", "n_removed", "n_spans")], F.coalesce("kept_sha256", nothing).alias("kept_sha256"))


def op5_pii_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data and of terms that give it away, in every document."""
    found = pii.sanitise(_documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", *[f"n_{k}" for k in pii.PATTERNS], F.sha2(pii.described(F.col("base_spans")), 256).alias("base_sha256"), pii.described(F.col("all_spans")).alias("spans"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def fold(doc_id) -> F.Column:
    """0 to 4, from the CRC-32 of the id as text; 0 is held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learnt outside the held-out fold."""
    docs = _documents(spark, sf_dir)
    dictionaries = langid.fit(docs.where(fold(F.col("doc_id")) != 0).select("doc_id", "text", "lang"), F.col("doc_id"))
    found = langid.identify(docs.select("doc_id", "text"), dictionaries)
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source."""
    docs = _documents(spark, sf_dir).select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(_documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id) of every document that contains a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contaminated_pairs(_documents(spark, sf_dir), items)


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster and squared distance of every vector, with inertia and digest of its centroid."""
    return centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical_search.search(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every document and of its edited text, and what they say of their likeness."""
    found = bottom_k.fingerprints(_documents(spark, sf_dir))
    own = F.col("sketch")
    return found.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        bottom_k.described(own).alias("fingerprint"),
        bottom_k.described(F.col("edited_sketch")).alias("edited_fingerprint"),
        bottom_k.resemblance(own, F.col("edited_sketch")).alias("near_edited"),
        bottom_k.resemblance(own, F.col("next_sketch")).alias("near_next"),
        bottom_k.containment(own, F.col("edited_sketch")).alias("contained_edited"),
        bottom_k.n_distinct(own).alias("n_shingles"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_lm_scoring,
        op2_source_mixing,
        op3_quality_rules,
        op4_suffix_dedup,
        op5_pii_sanitisation,
        op6_html_extraction,
        op7_language_id,
        op8_line_dedup,
        op9_simhash_near_dedup,
        op10_benchmark_decontamination,
        op11_centroid_clustering,
        op12_lexical_search,
        op13_document_fingerprints,
    )
}
