"""The pipeline against brute force, the registered queries against SQL, and plan rules."""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402
import edge  # noqa: E402
from fixtures import plan_text  # noqa: E402
from oracle_compare import compare, duck  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline  # noqa: E402
import __spark_entry__ as entry  # noqa: E402
from probelens.llm import langid  # noqa: E402
from probelens.llm.catalog import QUERIES  # noqa: E402
from probelens.llm.sql import ORACLE_SQL  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert len(corpus_pipeline.STAGES) == 5
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert QUERIES.keys() | {"pipeline"} <= entry.queries().keys()
    assert ORACLE_SQL.keys() <= entry.oracle_sql().keys() and "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    result = compare(spark, duck("/root/testdata/sf0.01"), name, QUERIES[name], ORACLE_SQL[name], "/root/testdata/sf0.01")
    assert result["cols_match"] and result["values_match"], result


def expected_stages(spark, rows, items):
    """What each stage keeps of (doc_id, text, lang, source, n_chars) rows, by brute force."""
    docs = spark.createDataFrame(rows, edge.SCHEMA)
    encoders = langid._encoders(langid.fit(docs, F.col("doc_id")), langid.LEVEL)
    guesses = [langid.classify(r[1], encoders) for r in rows]
    rows = [r for r, (lang, score) in zip(rows, guesses) if lang != "und" and score >= langid.MARGIN]
    yield rows
    texts = brute.boilerplate([(r[3], r[1]) for r in rows])
    rows = [r if t == r[1] else (r[0], t, r[2], r[3], len(t)) for r, t in zip(rows, texts)]
    yield rows
    best = {}
    for r, c in zip(rows, brute.components([brute.fingerprint(r[1]) for r in rows])):
        if c not in best or (r[0] is None, r[0]) < (best[c][0] is None, best[c][0]):
            best[c] = r
    rows = list(best.values())
    yield rows
    bad = {n for n, _ in brute.leaks([r[1] for r in rows], items)}
    rows = [r for n, r in enumerate(rows) if n not in bad]
    yield rows


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """The small table with hosts large enough for boilerplate, and awkward rows."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    rows = [(r[0], f"{r[1]}\nThis line stands on every page." if r[3] == "src1" else r[1], r[2], "src1" if r[0] % 3 else r[3], r[4]) for r in rows]
    rows += [(r[0] if r[0] is None else 10_000 + r[0], *r[1:]) for r in edge.ROWS if r[0] != 7] + [(10_007, *edge.ROWS[6][1:])]
    root = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, edge.SCHEMA).write.parquet(f"{root}/documents.parquet")
    spark.read.parquet(f"{SMALL}/benchmark.parquet").write.parquet(f"{root}/benchmark.parquet")
    return str(root), rows


def test_each_stage_and_the_whole_run(spark, corpus, tmp_path):
    root, rows = corpus
    items = [r.text for r in spark.read.parquet(f"{root}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns = docs.columns
    for (name, stage), want in zip(corpus_pipeline.STAGES, expected_stages(spark, rows, items)):
        stage(spark, docs, root).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        assert Counter(map(repr, map(tuple, docs.collect()))) == Counter(map(repr, want)), name
    last = corpus_pipeline.run(spark, root).collect()
    sizes = Counter()
    for r in want:
        sizes[r[3]] += len(brute.words(r[1]))
    goal, taken = brute.targets(sizes), Counter()
    known = {repr(r) for r in want}
    for r in last:
        assert repr(tuple(r)[:5]) in known and 1 <= r.copies <= 3 and r.taken == r.copies * r["size"]
        taken[r.source] += r.taken
    largest = max(len(brute.words(r[1])) for r in want)
    assert all(abs(taken[s] - goal[s]) <= 2 * largest + 2 for s in goal)


def test_stages_take_empty_and_cluttered_tables(spark, corpus):
    root, _ = corpus
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, edge.documents(spark, []), root).count() == 0
    docs = edge.cluttered(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, root)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        extra = [c for c in docs.columns if c not in ("doc_id", "text", "lang", "source", "n_chars", "m", "nothing")]
        rows = out.collect()
        assert rows and all(r[c] == "x" for r in rows for c in extra)


def test_registered_suffix_dedup_matches_brute_force(spark, corpus):
    """The query's own columns, which it derives from the operator's."""
    root, rows = corpus
    got = QUERIES["op4_suffix_dedup"](spark, root).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == Counter((r[0], *w) for r, w in zip(rows, brute.repeats([r[:2] for r in rows])))


NATIVE = ("op3_quality_rules", "op5_pii_sanitisation", "op8_line_dedup", "op10_benchmark_decontamination", "op13_document_fingerprints")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_have_no_pairs_and_native_ones_no_python(spark, name):
    plan = plan_text(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in NATIVE:
        assert not re.search("Python|Pandas|Arrow", plan)


#: One row per language; one per centroid; the terms of one block of items.
BOUNDED = ("langid.py", "centroids.py", "lexical_search.py")


def test_no_module_collects_or_checkpoints_locally():
    folder = os.path.dirname(os.path.abspath(langid.__file__))
    for f in os.listdir(folder):
        if f.endswith(".py"):
            source = open(os.path.join(folder, f), encoding="utf-8").read()
            assert "localCheckpoint" not in source and ".toPandas(" not in source and "crossJoin" not in source
            assert f in BOUNDED or ".collect(" not in source
