"""Toxicity by subword embeddings: a linear softmax on the averaged vectors of a word's character n-grams.

Vectors and softmax are trained together in NumPy, on a bounded sample of
labelled texts. A label says that some word of a text is toxic, not which. So
the model first learns from all words of a text alike, then only from those that
look toxic by now and the most toxic ones of harmless texts. A text's score is
that of the last of its few most toxic words; words never seen share n-grams with
known ones.

For scoring, a bucket's vector and the softmax come down to one number.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from numberplace.llm import words as W
from numberplace.llm.decontaminate import terms
from numberplace.llm.shared import shared

#: Labelled texts of each class that a model is fitted to, at most.
SAMPLE = 2_000
BUCKETS, DIMENSIONS = 1 << 18, 8
SIZES = (3, 4, 5, 6)
#: Buckets that fewer words of toxic texts fall into (each counted once a text) stay zero: they could only learn such words by heart.
LEAST_SUPPORT = 5
LEAST_STEPS = 150
THRESHOLD = 0.7
#: The part of a text's words that has to be toxic.
SHARE = 0.006
#: Words of a window; a text scores as its most toxic one.
WINDOW = 1_000

_BEGIN, _END, _WHOLE = np.uint64(0xA5A5F00DCAFE1234), np.uint64(0x1C69B3F74AC4AE35), np.uint64(0x7F4A7C159E3779B9)


class Model(NamedTuple):
    """What every bucket adds to the mean of a word, and the bias."""

    weights: np.ndarray
    bias: float


class Bags(NamedTuple):
    """Distinct terms of a chunk: the buckets of each, and which one every term of a text is."""

    buckets: np.ndarray
    begins: np.ndarray
    hashes: np.ndarray
    which: np.ndarray
    of: np.ndarray


def bags(chunk: W.Chunk) -> Bags:
    """N-grams are byte ranges of a term in lower case, marked where they begin or end it, and the term itself."""
    found = terms(chunk)
    hashes, at, which = np.unique(found.hashes, return_index=True, return_inverse=True)
    starts, sizes = found.starts[at], (found.ends - found.starts)[at]
    counts = [np.maximum(sizes - n + 1, 0) for n in SIZES] + [np.ones(len(at), np.int64)]
    total = np.sum(counts, axis=0) if len(at) else np.zeros(0, np.int64)
    begins = np.cumsum(total) - total
    grams = np.empty(int(total.sum()), np.uint64)
    fill = begins.copy()
    for n, count in zip((*SIZES, 0), counts, strict=True):
        own = np.repeat(np.arange(len(at)), count)
        inside = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        if n:
            first = starts[own] + inside
            value = W.range_hashes(chunk.data, first, first + n, lower=True)
            value = value ^ np.where(inside == 0, _BEGIN, np.uint64(0)) ^ np.where(inside == sizes[own] - n, _END, np.uint64(0))
        else:
            value = hashes ^ _WHOLE
        grams[fill[own] + inside] = value
        fill += count
    return Bags((W.mix(grams) % np.uint64(BUCKETS)).astype(np.int32), begins, hashes, which, found.of)


def word_logits(model: Model, bag: Bags) -> np.ndarray:
    """Of the distinct terms of a chunk."""
    if not len(bag.begins):
        return np.empty(0)
    sizes = np.diff(bag.begins, append=len(bag.buckets))
    return np.add.reduceat(model.weights[bag.buckets], bag.begins) / sizes + model.bias


def text_logits(model: Model, bag: Bags) -> np.ndarray:
    """Per text the highest logit that ``SHARE`` of a window's words reach, of one word at least; the bias for a text without any.

    A text is cut into equal windows of ``WINDOW`` words at most, and again half a window further on.
    """
    own = word_logits(model, bag)[bag.which]
    counts = np.diff(bag.of)
    out = np.where(counts > 0, -np.inf, model.bias)
    texts = np.repeat(np.arange(len(counts)), counts)
    windows = -(-counts // WINDOW)[texts]
    halves = (np.arange(len(own)) - bag.of[texts]) * 2 * windows // counts[texts]
    for shift in (0, 1):
        window = (halves + shift) // 2
        inside = np.flatnonzero((shift == 0) | ((window > 0) & (window < windows)))
        if not len(inside):
            continue
        text, logits = texts[inside], own[inside]
        fresh = np.append(True, (text[1:] != text[:-1]) | (window[inside[1:]] != window[inside[:-1]]))
        heads = np.flatnonzero(fresh)
        order = np.lexsort((-logits, np.cumsum(fresh)))
        nth = np.ceil(np.diff(heads, append=len(inside)) * SHARE).astype(np.int64) - 1
        np.maximum.at(out, text[heads], logits[order[heads + nth]])
    return out


class _Corpus(NamedTuple):
    buckets: np.ndarray
    begins: np.ndarray
    sizes: np.ndarray
    text_of: np.ndarray
    word_of: np.ndarray
    labels: np.ndarray

    def logits(self, model: Model) -> np.ndarray:
        return np.add.reduceat(model.weights[self.buckets], self.begins) / self.sizes + model.bias


def _corpus(texts: list[str], labels: np.ndarray) -> _Corpus:
    """All distinct words of the texts, and the distinct pairs of text and word."""
    known: dict[int, int] = {}
    parts, sizes, text_of, word_of = [], [], [], []
    for chunk in W.chunks(pa.array(texts, pa.large_string())):
        bag = bags(chunk)
        own = np.diff(bag.begins, append=len(bag.buckets))
        numbers = np.empty(len(bag.hashes), np.int64)
        for k, value in enumerate(bag.hashes.tolist()):
            numbers[k] = known.setdefault(value, len(known))
            if numbers[k] == len(sizes):
                sizes.append(own[k])
                parts.append(bag.buckets[bag.begins[k] : bag.begins[k] + own[k]])
        text = np.repeat(np.arange(len(bag.of) - 1), np.diff(bag.of)) + chunk.first
        pairs = np.unique(text * (1 << 32) + numbers[bag.which])
        text_of.append(pairs >> 32)
        word_of.append(pairs & 0xFFFFFFFF)
    none = np.empty(0, np.int64)
    sizes = np.array(sizes, np.int64)
    return _Corpus(np.concatenate([none.astype(np.int32), *parts]), np.cumsum(sizes) - sizes, sizes,
                   np.concatenate([none, *text_of]), np.concatenate([none, *word_of]), labels)


class _Trainer:
    """Vectors, softmax weights (class 1 against class 0) and bias, fitted by Adagrad."""

    def __init__(self, corpus: _Corpus, seed: int) -> None:
        random = np.random.RandomState(seed)
        self.corpus = corpus
        self.vectors = (random.rand(BUCKETS, DIMENSIONS).astype(np.float32) - 0.5) / DIMENSIONS
        self.softmax = (random.rand(DIMENSIONS).astype(np.float32) - 0.5)
        self.bias = np.float32(-2.0)
        toxic = np.bincount(corpus.word_of[corpus.labels[corpus.text_of] == 1], minlength=len(corpus.sizes))
        support = np.bincount(corpus.buckets, np.repeat(toxic, corpus.sizes), BUCKETS)
        self.learns = support >= LEAST_SUPPORT
        self.vectors[~self.learns] = 0
        self._of_vectors = np.full((BUCKETS, DIMENSIONS), 1e-6, np.float32)
        self._of_softmax = np.full(DIMENSIONS, 1e-6, np.float32)
        self._of_bias = np.float32(1e-6)

    def _grams(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.corpus.sizes[words]
        heads = np.cumsum(sizes) - sizes
        inside = np.arange(int(sizes.sum())) - np.repeat(heads, sizes)
        return self.corpus.buckets[np.repeat(self.corpus.begins[words], sizes) + inside], heads

    def means(self, words: np.ndarray) -> np.ndarray:
        buckets, heads = self._grams(words)
        return np.add.reduceat(self.vectors[buckets], heads) / self.corpus.sizes[words][:, None]

    def logits(self) -> np.ndarray:
        return self.corpus.logits(self.model())

    def step(self, words: np.ndarray, positive: np.ndarray, negative: np.ndarray, rate: float) -> None:
        """One step on words with the weights of their two labels."""
        mean = self.means(words)
        chance = 1 / (1 + np.exp(-(mean @ self.softmax + self.bias)))
        error = ((positive + negative) * chance - positive).astype(np.float32) / max(1e-9, float((positive + negative).mean()))
        of_softmax = error @ mean / len(words)
        of_mean = error[:, None] * self.softmax[None] / self.corpus.sizes[words][:, None]
        buckets, _ = self._grams(words)
        order = np.argsort(buckets, kind="stable")
        order = order[self.learns[buckets[order]]]
        own = np.repeat(np.arange(len(words)), self.corpus.sizes[words])[order]
        buckets = buckets[order]
        heads = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1]))
        of_vectors, touched = np.add.reduceat(of_mean[own], heads), buckets[heads]
        self._of_vectors[touched] += of_vectors**2
        self.vectors[touched] -= rate * of_vectors / np.sqrt(self._of_vectors[touched])
        self._of_softmax += of_softmax**2
        self.softmax -= rate * of_softmax / np.sqrt(self._of_softmax)
        of_bias = float(error.mean())
        self._of_bias += of_bias**2
        self.bias -= rate * of_bias / np.sqrt(self._of_bias)

    def model(self) -> Model:
        return Model((self.vectors @ self.softmax).astype(np.float32), float(self.bias))


def _top(corpus: _Corpus, logits: np.ndarray, label: int, words: int) -> np.ndarray:
    """How often each word is among the ``words`` most toxic ones of a text of that label."""
    own = corpus.labels[corpus.text_of] == label
    text_of, word_of = corpus.text_of[own], corpus.word_of[own]
    order = np.lexsort((-logits[word_of], text_of))
    rank = np.arange(len(order)) - np.searchsorted(text_of[order], text_of[order])
    return np.bincount(word_of[order][rank < words], minlength=len(corpus.sizes)).astype(np.float64)


def fit(texts: list[str], labels: np.ndarray, seed: int = 7, rounds: int = 4, refinements: int = 12) -> Model:
    """Fit a model to texts with labels 0 and 1; without both classes, one that finds nothing toxic.

    First every word has the labels of its texts. What then looks toxic in toxic
    texts is learnt once more, against the most toxic words of the other texts.
    """
    corpus = _corpus(texts, np.asarray(labels, np.int64))
    nothing = Model(np.zeros(BUCKETS, np.float32), -4.0)
    if not len(corpus.sizes) or len(np.unique(corpus.labels)) < 2:
        return nothing
    trainer, random, n_words = _Trainer(corpus, seed), np.random.RandomState(seed), len(corpus.sizes)
    toxic = corpus.labels[corpus.text_of] == 1
    positive = np.bincount(corpus.word_of[toxic], minlength=n_words).astype(np.float64)
    negative = np.bincount(corpus.word_of[~toxic], minlength=n_words).astype(np.float64)
    # As if toxic texts were a tenth of all.
    negative *= 9 * positive.sum() / max(1.0, negative.sum())
    parts = max(1, n_words // 2_000)
    for _ in range(max(rounds, -(-LEAST_STEPS // parts))):
        for words in np.array_split(random.permutation(n_words), parts):
            trainer.step(words, positive[words], negative[words], 0.3)
    looks_toxic = trainer.logits() > 0
    up = np.where(looks_toxic, positive, 0)
    if not up.any():
        return trainer.model()
    for _ in range(refinements):
        down = _top(corpus, trainer.logits(), 0, 5)
        chosen = np.flatnonzero(up + down)
        weight = down.sum() / up.sum()
        for part in np.array_split(random.permutation(chosen), max(1, len(chosen) // 256)):
            trainer.step(part, up[part] * weight, down[part], 0.3)
    return trainer.model()


def labelled_sample(
    df: DataFrame, labels: DataFrame, id_column: str, text: str, label: str, sample: int = SAMPLE
) -> tuple[list[str], np.ndarray]:
    """Up to ``sample`` texts of each label, chosen by a hash of the id; ids with remainder 1 are held out.

    Of rows of equal id, the text with the least hash is taken.
    """
    known = labels.filter(F.col(label).isin(0, 1) & ~held_out(id_column)).select(id_column, F.col(label).alias("_label")).distinct()
    texts, marks = [], []
    for value in (0, 1):
        chosen = known.filter(F.col("_label") == value).orderBy(F.xxhash64(id_column), id_column).limit(sample)
        found = df.select(id_column, F.col(text).alias("_text")).join(F.broadcast(chosen), id_column)
        # One text of each id, so that the driver gets no more than ``sample``.
        first = F.min(F.struct(F.xxhash64("_text").alias("hash"), F.col("_text").alias("text"))).alias("first")
        rows = found.groupBy(id_column).agg(first).orderBy(F.xxhash64(id_column), id_column).select("first.text").toArrow()
        texts += [x or "" for x in rows["text"].to_pylist()]
        marks += [value] * (len(texts) - len(marks))
    return texts, np.array(marks, np.int64)


def held_out(id_column: str) -> Column:
    """Whether an id belongs to the third that nothing is learnt from; a null id does not."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_texts(df: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: the id, ``held_out``, ``score`` and ``predicted``; null texts are empty and score like a text without words."""
    opened = shared(df.sparkSession, model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = opened()
        for batch in batches:
            parts = [text_logits(own, bags(chunk)) for chunk in W.chunks(batch.column("text"))]
            logits = np.concatenate([np.empty(0), *parts])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array(1 / (1 + np.exp(-logits)))], ["id", "held_out", "score"])

    named = df.select(F.col(id_column).alias("id"), held_out(id_column).alias("held_out"), F.col(text).alias("text"))
    scored = named.mapInArrow(score, f"id {dict(df.dtypes)[id_column]}, held_out boolean, score double")
    return scored.select(F.col("id").alias(id_column), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def toxicity(
    df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic",
    sample: int = SAMPLE,
) -> DataFrame:
    """Fit on a sample of labelled rows that are not held out, then score every row of ``df``."""
    return score_texts(df, fit(*labelled_sample(df, labels, id_column, text, label, sample)), id_column, text)
