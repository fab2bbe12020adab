"""A corpus cleaned and encoded in stages, each written as Parquet and read again.

The stages keep the columns of ``documents`` up to the last one, which returns
token digests per remaining document:

1. ``quality_rules``: documents that the rules or the perplexity bands reject go.
2. ``line_dedup``: later repeated runs of lines are deleted; documents of which no
   word remains go, ``n_chars`` follows the text.
3. ``ngram_jaccard``: of documents linked by their shingles, the one with the
   smallest id stays (one row of it). Rows without an id stay.
4. ``decontamination``: documents that hold a benchmark item go.
5. ``sentencepiece``: the rest is encoded.

Rows of equal id, language and text are judged alike; ids may be null.

A stage deletes what the one before it has left in the scratch folder, since that
one's rows are written by then; a table that still reads from there keeps it. The
driver gives back the memory that stage has left unused, too.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from numberplace.llm.decontaminate import item_matches
from numberplace.llm.jaccard import jaccard_components
from numberplace.llm.line_runs import delete_repeated_lines
from numberplace.llm.quality import quality_rules
from numberplace.llm.queries import encoded_documents
from numberplace.session import delete_scratch, release_memory, scratch_folder, scratch_path, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_KEY = "_numberplace_key"
#: Scratch folders of stages whose rows may not be written yet.
_left: list[str] = []


def _cleaning(stage: Stage) -> Stage:
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles() if _left else []
        for folder in [f for f in _left if not any(f.rpartition("/")[2] in file for file in read)]:
            _left.remove(folder)
            delete_scratch(spark, folder)
        release_memory(spark)
        with scratch_folder(spark) as folder:
            _left.append(folder)
            return stage(spark, docs, sf_dir)

    return run_stage


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents with a key that equal rows share; unlike the id it is never null."""
    return docs.withColumn(_KEY, F.xxhash64("doc_id", "lang", "text"))


@_cleaning
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = stored(quality_rules(_keyed(docs), id_column=_KEY).filter("kept").select(_KEY).distinct())
    return _keyed(docs).join(kept, _KEY, "left_semi").select(docs.columns)


@_cleaning
def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = delete_repeated_lines(docs).filter(r"n_deleted_lines = 0 OR text RLIKE '[^\\x20\\x09-\\x0D]'")
    changed = F.when(F.col("n_deleted_lines") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed).select(docs.columns)


@_cleaning
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    heads = stored(jaccard_components(docs).filter("doc_id = component_id").select("doc_id").distinct())
    first = Window.partitionBy("doc_id").orderBy(F.char_length("text").desc(), "text")
    kept = docs.join(heads, "doc_id", "left_semi").withColumn(_KEY, F.row_number().over(first)).filter(F.col(_KEY) == 1)
    return kept.select(docs.columns).unionByName(docs.filter("doc_id IS NULL"))


@_cleaning
def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = stored(item_matches(_keyed(docs), items, id_column=_KEY).select(_KEY).distinct())
    return _keyed(docs).join(found, _KEY, "left_anti").select(docs.columns)


@_cleaning
def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoded_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard", near_duplicate_stage),
    ("decontamination", benchmark_stage),
    ("sentencepiece", encoding_stage),
]

#: Perplexity bands and encoding have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows are returned unwritten."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for position, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if position < len(STAGES) - 1:
            path = scratch_path(spark)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
