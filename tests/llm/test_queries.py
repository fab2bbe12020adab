import subprocess
import sys
from pathlib import Path

import pytest

import corpus_pipeline
from numberplace.llm import queries as Q
from tools.check import difference, oracle

from .conftest import SF, rows_of

ROOT = Path(__file__).resolve().parents[2]


@pytest.mark.parametrize("name", list(Q.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    df = Q.QUERIES[name](spark, SF)
    assert difference([tuple(r) for r in df.collect()], df.columns, Q.ORACLE_SQL[name], oracle(SF)) is None


@pytest.mark.parametrize("name", list(Q.QUERIES))
def test_one_row_per_row(spark, name):
    found = Q.QUERIES[name](spark, SF)
    columns = found.columns
    # The one without an id of the table has a row per phrase.
    keyed = {"page_id": "pages", "conv_id": "conversations", "doc_id": "documents"}
    key = next((k for k in keyed if k in columns), None)
    if key is None or name == "op8_decontamination":
        assert name in ("op8_decontamination", "op11_phrase_collocations") and found.count()
        return
    rows = spark.read.parquet(f"{SF}/{keyed[key]}.parquet").select(key)
    ids = sorted(r[0] for r in (rows.distinct() if key == "conv_id" else rows).collect())
    assert sorted(r[0] for r in found.select(key).collect()) == ids and columns


def test_all_ten_and_the_pipeline_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


def test_stages_on_awkward_documents(spark, awkward_docs, tmp_path):
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    awkward_docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    docs = awkward_docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, f"file://{tmp_path}")
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    for _, stage in corpus_pipeline.STAGES:
        assert rows_of(stage(spark, docs.limit(0), f"file://{tmp_path}")) == []


def test_stage_decisions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    judged = {r.doc_id: r.kept for r in Q.op6_quality_rules(spark, SF).collect()}
    after = corpus_pipeline.quality_stage(spark, docs, SF)
    assert {r.doc_id for r in after.collect()} == {k for k, kept in judged.items() if kept}
    heads = {r.component_id for r in Q.op1_ngram_jaccard(spark, SF).collect()}
    assert {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect()} == heads
    found = {r.doc_id for r in Q.op8_decontamination(spark, SF).collect()}
    kept = {r.doc_id for r in corpus_pipeline.benchmark_stage(spark, docs, SF).collect()}
    assert found and kept == {r.doc_id for r in docs.collect()} - found
    lines = {r.doc_id: r.text for r in Q.op4_line_dedup(spark, SF).collect()}
    for r in corpus_pipeline.line_stage(spark, docs, SF).collect():
        assert r.text == lines[r.doc_id]


def test_the_rest_works_without_the_subpackage():
    code = ("import sys; sys.modules['corpus_pipeline'] = None\n"
            "import __spark_entry__ as e; assert 'pair_count' in e.queries() and 'pipeline' not in e.queries(); assert e.oracle_sql()")
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, timeout=120).returncode == 0
