"""The queries of the subpackage: thin applications of its operators to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from numberplace.llm import conversations, id_files, line_runs, phrase_graph, url_rules, warc
from numberplace.llm.decontaminate import item_matches
from numberplace.llm.html_text import main_text
from numberplace.llm.jaccard import jaccard_components
from numberplace.llm.pieces_codec import piece_digests
from numberplace.llm.quality import quality_rules
from numberplace.llm.suffix_trees import delete_repeated_passages
from numberplace.llm.toxicity import toxicity
from numberplace.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """The path of an installed public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoded_documents(docs: DataFrame) -> DataFrame:
    return piece_digests(docs, tokenizer_path("piece_bpe_32k.model"))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives, as they are read back."""
    path = scratch_path(spark)
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    records = warc.read_archives(spark, path)
    return records.select(
        F.col("page_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without later repeated runs of 50 words or more."""
    deleted = line_runs.delete_repeated_lines(_table(spark, sf_dir, "documents"))
    return deleted.select("doc_id", "n_lines", "n_deleted_lines", "text")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_documents(_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the benchmark items found in them."""
    return item_matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


URL_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all URLs; labels come from the rules, else from the document that a URL's number names.

    A labelled document of low quality or with toxic text speaks for ``block``.
    """
    pages = _table(spark, sf_dir, "pages")
    number = F.regexp_extract(url_rules.path("url"), r"/([0-9]{1,18})(\.html)?/?$", 1)
    numbered = pages.select("page_id", F.nullif(number, F.lit("")).try_cast("bigint").alias("doc_id"))
    verdict = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), "block").otherwise("allow")
    labelled = numbered.join(_table(spark, sf_dir, "labels"), "doc_id").select("page_id", verdict.alias("label"))
    judged = url_rules.judge(pages, URL_RULES, labelled)
    return judged.withColumn("mined", F.array_join("mined", " "))


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written in coded blocks, as they are read back."""
    import public_tokenizers

    path = scratch_path(spark)
    id_files.write_ids(
        _table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"),
        tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return id_files.read_digests(spark, path)


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest phrases of two and three words of each language."""
    return phrase_graph.collocations(_table(spark, sf_dir, "documents"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults by a hash of id and turn; a dropped row stays as ``present`` = false.

    0 drops a row, 1 empties its text, 2 takes out its sentence marks, 3 repeats it, 4 makes it a user's.
    """
    cell = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", cell("conv_id"), cell("turn"))) % 20
    hit = rows.select("conv_id", "turn", cell("role").alias("role"), cell("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return hit.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("kind") != 0).alias("present"), F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits of damaged conversations, with the digests of the repaired ones."""
    repair = conversations.repair_conversations(damaged(_table(spark, sf_dir, "conversations")), present=F.col("present"))
    named = conversations.digests(repair.turns).withColumnRenamed("conv_id", "c")
    return repair.audits.join(named, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that stay after passages of 50 words which an earlier document holds have gone."""
    deleted = delete_repeated_passages(_table(spark, sf_dir, "documents"))
    return deleted.select("doc_id", "n_words", "n_removed", "kept_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_toxicity": op2_toxicity,
    "op3_warc": op3_warc,
    "op4_line_dedup": op4_line_dedup,
    "op5_html_extraction": op5_html_extraction,
    "op6_quality_rules": op6_quality_rules,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_decontamination": op8_decontamination,
    "op9_url_filters": op9_url_filters,
    "op10_token_ids": op10_token_ids,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_substring_dedup": op13_substring_dedup,
}

#: Queries without SQL here are held against brute force in ``tests/llm``.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(hex, {5 * k + 1}, 5) AS INTEGER) >> {5 * j}) & 31), 1)"
    for k in range(8) for j in (3, 2, 1, 0)
)
_WARC_SQL = f"""
    WITH digests AS (
      SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
    latest AS (SELECT *, max(page_id) OVER (PARTITION BY hex, payload_bytes) AS last FROM digests)
    SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
           CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> last THEN last END AS refers_to
    FROM latest"""

ORACLE_SQL: dict[str, str] = {
    "op3_warc": _WARC_SQL,
    "op4_line_dedup": line_runs.oracle_sql(),
    "op11_phrase_collocations": phrase_graph.oracle_sql(),
}
