"""Quality rules: counts over whole texts, and perplexity bands per language.

Base rules reject texts with few words or with many repeated ones. The rest is
judged by the perplexity per word, spelt in characters, under a Kneser-Ney model of all
texts (``perplexity``): each language has a lower and an upper bound, a number
of robust deviations around the median of its texts that pass the base rules.
A second model, of n-grams across words, sets another upper bound in the same way, which
rejects words out of their order; it has no lower bound, since copies are well foreseen.

A null text is an empty one, a null language a language of its own. Repeated
rows are judged one by one. Columns of the input other than the named ones play
no part.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from numberplace.llm import perplexity as P
from numberplace.llm import words as W
from numberplace.session import stored

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: Deviations (1.4826 median absolute deviations) that a text may lie below and above its language's median.
BELOW, ABOVE = 6.0, 10.0
#: The least deviation, in log perplexity; a language with hardly any spread has no sharp bounds.
LEAST_DEVIATION = 0.1

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LINE = np.ones(256, bool)
_LINE[0x0A] = False
_LOG_SUMS = ("log_sum", "run_log_sum")
_TEXT_KEY = "_numberplace_text_key"
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Counts(NamedTuple):
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per hash, whether it occurs twice or more, and whether it occurred before."""
    order = W.order_of(keys)
    same = np.zeros(len(keys) + 1, bool)
    ordered = keys[order]
    same[1:-1] = ordered[1:] == ordered[:-1]
    often, later = np.empty(len(keys), bool), np.empty(len(keys), bool)
    often[order], later[order] = same[:-1] | same[1:], same[:-1]
    return often, later


def _within(hashes: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Hashes that differ between texts."""
    return W.mix(hashes + W.mix(texts.astype(np.uint64) + np.uint64(1)))


def count(chunk: W.Chunk, found: W.Words) -> Counts:
    texts = np.arange(len(chunk.bounds) - 1)
    starts, ends, of = W.pieces(chunk, _LINE)
    spoken = np.searchsorted(found.starts, ends) > np.searchsorted(found.starts, starts)
    lines = _within(W.range_hashes(chunk.data, starts, ends), np.repeat(texts, np.diff(of)))
    later = np.zeros(len(starts), bool)
    later[spoken] = _repeats(lines[spoken])[1]
    of_text = np.repeat(texts, np.diff(found.of))
    repeated = np.zeros(len(of_text), bool)
    if len(of_text) >= 3:
        grams = W.grams(found.hashes, 3)
        at = np.flatnonzero(of_text[2:] == of_text[:-2])
        often = at[_repeats(_within(grams[at], of_text[at]))[0]]
        for k in range(3):
            repeated[often + k] = True
    return Counts(
        np.diff(found.of),
        _per_text(W.SOLID[chunk.data] & ((chunk.data & 0xC0) != 0x80), chunk.bounds),
        _per_text(_SYMBOL[chunk.data], chunk.bounds),
        _per_text(later, of),
        _per_text(repeated, found.of),
    )


def text_scores(
    df: DataFrame, sent: Callable[[], P.Model], first: bool, id_columns: list[str], text: str, language: str
) -> DataFrame:
    """Per row the summed log probabilities, of its words and as running text, under one part of the model.

    The counts come along with the first part.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_model = sent()
        for batch in batches:
            logs, run_logs = np.zeros(len(batch)), np.zeros(len(batch))
            counts = np.zeros((len(_COUNTS), len(batch)), np.int64)
            for name, rows, column in P._by_language(batch, language, text):
                for chunk in W.chunks(column, 2 * W.CHUNK_BYTES):
                    own = rows[chunk.first : chunk.first + len(chunk.bounds) - 1]
                    values, found = P.word_scores(own_model, name, chunk)
                    sums = np.zeros(len(values) + 1)
                    np.cumsum(values, out=sums[1:])
                    logs[own] = sums[found.of[1:]] - sums[found.of[:-1]]
                    run_logs[own] = P.text_scores(own_model, name, chunk, found)
                    if first:
                        counts[:, own] = count(chunk, found)
            done = [pa.array(logs), pa.array(run_logs)] + (list(map(pa.array, counts)) if first else [])
            yield pa.RecordBatch.from_arrays([*map(batch.column, id_columns), batch.column(language), *done], names)

    names = [*id_columns, language, *_LOG_SUMS] + (list(_COUNTS) if first else [])
    types = dict(df.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in id_columns) + f", `{language}` string, " + ", ".join(f"{c} double" for c in _LOG_SUMS)
    if first:
        schema += ", " + ", ".join(f"{c} long" for c in _COUNTS)
    return df.select(*id_columns, language, text).mapInArrow(score, schema)


def _with_text_key(df: DataFrame, id_column: str, text: str, language: str) -> DataFrame:
    """The id, language and text with a key that exactly the rows of equal language and text share, never null."""
    both = F.concat(F.coalesce(F.col(language), F.lit("")), F.lit("\0"), F.coalesce(F.col(text), F.lit("")))
    return df.select(id_column, language, text, F.unhex(F.md5(both.cast("binary"))).alias(_TEXT_KEY))


def quality_rules(
    df: DataFrame,
    model: DataFrame | None = None,
    id_column: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    min_words: int = MIN_WORDS,
    max_repeated_percent: int = MAX_REPEATED_PERCENT,
    below: float = BELOW,
    above: float = ABOVE,
) -> DataFrame:
    """Per row: the id, the counts, ``base_failed``, ``perplexity`` and ``kept``.

    ``model`` is the table of ``perplexity.fit``; by default it is fitted to ``df``.
    Ids may be null or repeated: where the model takes more than one part, the parts'
    sums are added up per distinct language and text, which are all they depend on.
    ``perplexity`` is null for a text without words.
    """
    model = model if model is not None else P.fit(df, language, text)
    parts = P.part_count(model)
    id_columns = [id_column] if parts == 1 else [id_column, _TEXT_KEY]
    texts = df if parts == 1 else _with_text_key(df, id_column, text, language)
    passes = []
    for part in range(parts):
        with P.sent(model, part, parts) as sent:
            passes.append(stored(text_scores(texts, sent, part == 0, id_columns, text, language)))
    scored = passes[0]
    if parts > 1:
        sums = functools.reduce(DataFrame.unionByName, [
            p.groupBy(_TEXT_KEY).agg(*(F.max(c).alias(c) for c in _LOG_SUMS)) for p in passes])
        sums = sums.groupBy(_TEXT_KEY).agg(*(F.sum(c).alias(c) for c in _LOG_SUMS))
        scored = stored(scored.drop(*_LOG_SUMS).join(sums, _TEXT_KEY))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated_percent * F.col("n_words"))
    scored = (
        scored.withColumn("log_perplexity", -F.col("log_sum") / F.nullif(F.col("n_words"), F.lit(0)))
        .withColumn("run_log_perplexity", -F.col("run_log_sum") / F.nullif(F.col("n_words"), F.lit(0)))
        .withColumn("base_failed", failed)
    )
    bands = _bands(scored, language, ["log_perplexity", "run_log_perplexity"], below, above)
    inside = F.col("log_perplexity").between(F.col("log_perplexity_lower"), F.col("log_perplexity_upper")) & (
        F.col("run_log_perplexity") <= F.col("run_log_perplexity_upper"))
    return (
        scored.withColumn("_language", F.coalesce(F.col(language), F.lit("")))
        .join(bands, "_language", "left")
        .select(
            id_column, *_COUNTS, "base_failed",
            (~F.col("base_failed") & inside).alias("kept"),
            F.exp("log_perplexity").alias("perplexity"),
        )
    )


def _bands(scored: DataFrame, language: str, values: list[str], below: float, above: float) -> DataFrame:
    """(_language, <value>_lower, <value>_upper, ...) from the texts that pass the base rules; stored, a row per language."""
    passed = scored.filter("NOT base_failed").select(F.coalesce(F.col(language), F.lit("")).alias("_language"), *values)
    middle = stored(passed.groupBy("_language").agg(*(F.percentile_approx(v, 0.5, 10_000).alias(f"{v}_middle") for v in values)))
    spread = passed.join(middle, "_language").groupBy("_language").agg(
        *(F.first(f"{v}_middle").alias(f"{v}_middle") for v in values),
        *(F.percentile_approx(F.abs(F.col(v) - F.col(f"{v}_middle")), 0.5, 10_000).alias(f"{v}_deviation") for v in values),
    )
    limits = []
    for v in values:
        deviation = F.greatest(1.4826 * F.col(f"{v}_deviation"), F.lit(LEAST_DEVIATION))
        limits += [(F.col(f"{v}_middle") - below * deviation).alias(f"{v}_lower"),
                   (F.col(f"{v}_middle") + above * deviation).alias(f"{v}_upper")]
    return stored(spread.select("_language", *limits))
