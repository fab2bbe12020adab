"""Test items found in documents: BM25 with block-max WAND, then overlap of question and answer.

A document's passages are windows of its terms that overlap by half. Items of a
like length are sought together, in passages whose step is no shorter than they
are, so a copied item lies whole in some passage, whatever other items there are.
Weights are BM25 weights divided by the score that an item has to reach, a share
of what its own text scores, so a passage retrieves an item at a sum of 1.

Terms of an item are essential unless all its other terms together weigh less
than ``SPARE``; a passage without essential terms of enough weight cannot
retrieve the item. That is tested for all passages of a chunk at once; those that
may retrieve something go through block-max WAND, which returns every item at or
above the threshold. An item counts as found where enough of the word triples of
its question and of its answer stand in the passage.

The index is sent to the executors in parts of at most ``INDEX_ITEMS`` items of
one level of length, one pass over the documents per part.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from numberplace.llm import words as W
from numberplace.llm.shared import shared
from numberplace.session import stored

#: Least step between passages in terms; share of its own score that retrieves an item; share of triples that verifies.
STEP, SHARE, OVERLAP = 64, 0.5, 0.6
#: Items in a part of the index, of ``ITEM_TERMS`` terms on average at most.
INDEX_ITEMS, ITEM_TERMS = 10_000, 400
K1, B = 1.2, 0.75
SPARE = 0.5
_BLOCK = 32

_TERM = np.zeros(256, bool)
_TERM[np.r_[48:58, 65:91, 97:123, 128:256]] = True


class Index(NamedTuple):
    """``vocabulary`` (sorted hashes) with postings per term; items are numbered in order.

    ``items[k]`` and ``weights[k]`` are the postings of term k, ``blocks[k]`` and
    ``peaks[k]`` its blocks of items and the greatest weight in each.
    ``begins``, ``essential`` and ``essential_weights`` are flat postings of the
    essential terms; ``need`` is the essential weight that an item takes.
    """

    vocabulary: np.ndarray
    items: list[list[int]]
    weights: list[list[float]]
    blocks: list[list[int]]
    peaks: list[list[float]]
    begins: np.ndarray
    essential: np.ndarray
    essential_weights: np.ndarray
    need: np.ndarray
    ids: pa.Array
    question: list[np.ndarray]
    answer: list[np.ndarray]
    step: int


def terms(chunk: W.Chunk) -> W.Words:
    """Runs of ASCII letters and digits and of non-ASCII bytes, A-Z in lower case."""
    starts, ends, of = W.pieces(chunk, _TERM)
    return W.Words(starts, ends, W.range_hashes(chunk.data, starts, ends, lower=True), of)


def text_terms(text: str) -> np.ndarray:
    return terms(next(W.chunks(pa.array([text])))).hashes


def triples(hashes: np.ndarray) -> np.ndarray:
    """Distinct hashes of three terms in a row; of all terms, if there are fewer."""
    return np.unique(W.grams(hashes, min(3, len(hashes)))) if len(hashes) else hashes


def _all_grams(hashes: np.ndarray) -> np.ndarray:
    return np.concatenate([W.grams(hashes, size) for size in (1, 2, 3)])


def _overlap(wanted: np.ndarray, there: np.ndarray) -> float:
    return float(np.isin(wanted, there).mean()) if len(wanted) else 1.0


def question_and_answer(text: str) -> tuple[str, str]:
    """The answer is the last sentence with a term; a single sentence is cut at three quarters of its words."""
    sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n", text) if re.search(r"\w", s)]
    if len(sentences) > 1:
        return " ".join(sentences[:-1]), sentences[-1]
    words = text.split()
    cut = max(1, len(words) * 3 // 4)
    return " ".join(words[:cut]), " ".join(words[cut:]) or text


def item_terms(items: DataFrame) -> DataFrame:
    """(item, term, tf, length) for all terms of all items (item, text)."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, value in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                hashes, counts = np.unique(text_terms(value or ""), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(hashes), item, np.int64)), pa.array(hashes.view(np.int64)),
                     pa.array(counts.astype(np.int64)), pa.array(np.full(len(hashes), counts.sum(), np.int64))],
                    ["item", "term", "tf", "length"])

    return items.select("item", "text").mapInArrow(split, "item long, term long, tf long, length long")


def indexes(items: DataFrame, id_column: str = "item_id", text: str = "text", share: float = SHARE) -> Iterator[Index]:
    """The parts of the index; frequencies and lengths are those of all items, of which equal rows are one.

    Items of a like length (up to ``STEP`` terms, twice as many, four times, ...)
    go together, as their length sets that of the passages they are sought in.
    """
    numbered = items.select(F.col(id_column).alias("id"), F.col(text).alias("text")).distinct()
    numbered = stored(numbered.withColumn("item", F.monotonically_increasing_id()))
    found = stored(item_terms(numbered))
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.col("length") / STEP)))
    sizes = stored(found.groupBy("item").agg(F.first("length").alias("length"), F.count("*").alias("rows")).withColumn("level", level))
    total = sizes.agg(F.count("*").alias("n"), F.avg("length").alias("mean")).first()
    if not total.n:
        return
    document_counts = found.groupBy("term").agg(F.count("*").alias("df"))
    weighed = stored(found.join(document_counts, "term").join(sizes.select("item", "level"), "item"))
    texts = stored(numbered.join(sizes.select("item", "level"), "item"))
    # A level for each doubling of the length, so a few dozen at most.
    levels = sizes.groupBy("level").agg(F.count("*").alias("n"), F.sum("rows").alias("rows")).orderBy("level").collect()
    for own in levels:
        parts = max(-(-own.n // INDEX_ITEMS), -(-own.rows // (INDEX_ITEMS * ITEM_TERMS)))
        for part in range(parts):
            chosen = (F.col("level") == own.level) & (F.pmod(F.xxhash64("item"), F.lit(parts)) == part)
            known = texts.filter(chosen).select("item", "id", "text").orderBy("item").toArrow().combine_chunks()
            if len(known):
                table = weighed.filter(chosen).orderBy("item", "term").toArrow().combine_chunks()
                yield _index(known, table, total.n, total.mean, STEP << int(own.level), share)


def _index(known: pa.Table, table: pa.Table, n: int, mean: float, step: int, share: float) -> Index:
    item = np.searchsorted(known["item"].to_numpy(), table["item"].to_numpy())
    tf, length, df = (table[c].to_numpy().astype(np.float64) for c in ("tf", "length", "df"))
    weight = np.log1p((n - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))
    own = np.bincount(item, weight)
    weight /= share * own[item]
    vocabulary, term = np.unique(table["term"].to_numpy().view(np.uint64), return_inverse=True)
    # Per item, terms from the lightest on are spared while they stay below SPARE.
    order = np.lexsort((weight, item))
    sums = np.cumsum(weight[order])
    before = np.concatenate([[0], sums])[np.searchsorted(item[order], item[order])]
    spared = np.zeros(len(item), bool)
    spared[order] = sums - before < SPARE
    need = 1 - np.bincount(item, np.where(spared, weight, 0))
    items, weights = [[] for _ in vocabulary], [[] for _ in vocabulary]
    for t, i, w in zip(term.tolist(), item.tolist(), weight.tolist(), strict=True):
        items[t].append(i)
        weights[t].append(w)
    blocks, peaks = [], []
    for own_items, own_weights in zip(items, weights, strict=True):
        highest: dict[int, float] = defaultdict(float)
        for i, w in zip(own_items, own_weights, strict=True):
            highest[i // _BLOCK] = max(highest[i // _BLOCK], w)
        blocks.append(list(highest))
        peaks.append(list(highest.values()))
    kept = np.flatnonzero(~spared)
    kept = kept[np.argsort(term[kept], kind="stable")]
    begins = np.searchsorted(term[kept], np.arange(len(vocabulary) + 1))
    halves = [question_and_answer(text) for text in known["text"].to_pylist()]
    return Index(vocabulary, items, weights, blocks, peaks, begins, item[kept], weight[kept], need,
                 known["id"].combine_chunks(), [triples(text_terms(q)) for q, _ in halves],
                 [triples(text_terms(a)) for _, a in halves], step)


def wand(index: Index, query: list[int]) -> list[tuple[int, float]]:
    """Every item whose summed weight over the query's terms is 1 or more, in order."""
    found = []
    lists = [[index.items[t][0], 0, t, max(index.peaks[t])] for t in query]
    while lists:
        lists.sort()
        reach, pivot = 0.0, -1
        for k, (_, _, _, peak) in enumerate(lists):
            reach += peak
            if reach >= 1 - 1e-9:
                pivot = k
                break
        if pivot < 0:
            break
        item = lists[pivot][0]
        while pivot + 1 < len(lists) and lists[pivot + 1][0] == item:
            pivot += 1
        block, bound = item // _BLOCK, 0.0
        for _, _, t, _ in lists[: pivot + 1]:
            at = bisect_left(index.blocks[t], block)
            if at < len(index.blocks[t]) and index.blocks[t][at] == block:
                bound += index.peaks[t][at]
        if bound >= 1 - 1e-9:
            if lists[0][0] == item:
                score = sum(index.weights[t][at] for _, at, t, _ in lists[: pivot + 1])
                if score >= 1 - 1e-9:
                    found.append((item, score))
                target = item + 1
            else:
                target = item
        else:  # no item of this block can do, unless a list further on joins in
            target = (block + 1) * _BLOCK
            if pivot + 1 < len(lists):
                target = min(target, lists[pivot + 1][0])
            target = max(target, item + 1)
        moved = []
        for entry in lists[: pivot + 1]:
            own = index.items[entry[2]]
            at = bisect_left(own, target, entry[1])
            if at < len(own):
                moved.append([own[at], at, entry[2], entry[3]])
        lists = moved + lists[pivot + 1 :]
    return found


def _likely(index: Index, found: W.Words) -> dict[int, list[tuple[int, int]]]:
    """Passages (first term, behind the last) per text that have enough essential weight for some item."""
    at = np.searchsorted(index.vocabulary, found.hashes)
    at[at == len(index.vocabulary)] = 0
    at[index.vocabulary[at] != found.hashes] = -1
    places = np.flatnonzero(at >= 0)
    sizes = index.begins[at[places] + 1] - index.begins[at[places]]
    places, sizes = places[sizes > 0], sizes[sizes > 0]
    if not len(places):
        return {}
    term = np.repeat(at[places], sizes)
    posting = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + index.begins[term]
    place = np.repeat(places, sizes)
    text = np.searchsorted(found.of, place, "right") - 1
    # A place lies in the passage that starts at or before it, and in the one before that.
    slot = (place - found.of[text]) // index.step
    steps = -(-np.diff(found.of) // index.step)
    base = np.concatenate([[0], np.cumsum(steps)])
    passage = base[text] + slot
    earlier = slot > 0
    passage = np.concatenate([passage, passage[earlier] - 1])
    term, posting = np.concatenate([term, term[earlier]]), np.concatenate([posting, posting[earlier]])
    order = np.lexsort((posting, passage))
    passage, posting = passage[order], posting[order]
    fresh = np.ones(len(passage), bool)
    fresh[1:] = (passage[1:] != passage[:-1]) | (posting[1:] != posting[:-1])
    passage, posting = passage[fresh], posting[fresh]
    item = index.essential[posting]
    key = passage * len(index.need) + item
    keys, which = np.unique(key, return_inverse=True)
    sums = np.bincount(which, index.essential_weights[posting])
    likely = np.unique(keys[sums >= index.need[keys % len(index.need)] - 1e-9] // len(index.need))
    texts = np.searchsorted(base, likely, "right") - 1
    spans: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for t, p in zip(texts.tolist(), likely.tolist(), strict=True):
        first = int(found.of[t]) + (p - int(base[t])) * index.step
        spans[t].append((first, min(first + 2 * index.step, int(found.of[t + 1]))))
    return spans


def _matches(index: Index, found: W.Words) -> Iterator[tuple[int, int, int, float, float, float]]:
    """(text, item, first term of the passage, score, question overlap, answer overlap)."""
    for text, spans in _likely(index, found).items():
        for first, last in spans:
            own = found.hashes[first:last]
            at = np.searchsorted(index.vocabulary, own)
            at[at == len(index.vocabulary)] = 0
            query = np.unique(at[index.vocabulary[at] == own]).tolist()
            grams = None
            for item, score in wand(index, query):
                grams = _all_grams(own) if grams is None else grams
                asked, answered = _overlap(index.question[item], grams), _overlap(index.answer[item], grams)
                yield text, item, first - int(found.of[text]), score, asked, answered


def item_matches(
    df: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    share: float = SHARE,
    overlap: float = OVERLAP,
) -> DataFrame:
    """(id, item id, passage, score, question_overlap, answer_overlap) of the items found in each document.

    One row per document and item, from its best passage: ``passage`` is the
    number of its first term, ``score`` the share of the item's own BM25 score.
    Null and empty texts match nothing and are matched by nothing; rows of equal
    id are one document, items of equal id and other text are compared one by one.
    """
    types, item_types = dict(df.dtypes), dict(items.dtypes)
    schema = (f"_document {types[id_column]}, _item {item_types[item_id]}, passage long, score double, "
              "question_overlap double, answer_overlap double")

    def finder(index: Index):  # noqa: ANN202
        opened = shared(df.sparkSession, index)

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = opened()
            for batch in batches:
                for chunk in W.chunks(batch.column(text)):
                    rows = [m for m in _matches(own, terms(chunk)) if min(m[4:]) >= overlap]
                    if rows:
                        number, item, passage, score, asked, answered = zip(*rows, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(id_column).take(pa.array([chunk.first + k for k in number])),
                             own.ids.take(pa.array(item)), pa.array(passage, pa.int64()),
                             pa.array([share * s for s in score]), pa.array(asked), pa.array(answered)],
                            ["_document", "_item", "passage", "score", "question_overlap", "answer_overlap"])

        return find

    found = None
    for index in indexes(items, item_id, item_text, share):
        own = df.select(id_column, text).mapInArrow(finder(index), schema)
        found = own if found is None else found.unionByName(own)
    if found is None:
        found = df.sparkSession.createDataFrame([], schema)
    best = F.max_by(F.struct("passage", "score", "question_overlap", "answer_overlap"),
                    F.struct(F.least("question_overlap", "answer_overlap"), "score", -F.col("passage")))
    best = found.groupBy("_document", "_item").agg(best.alias("best"))
    return best.select(F.col("_document").alias(id_column), F.col("_item").alias(item_id), "best.*")


def drop_contaminated(df: DataFrame, items: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The rows of ``df`` in whose document no item is found; rows with a null id stay."""
    found = item_matches(df, items, id_column, **options).select(id_column).distinct()
    return df.join(found, id_column, "left_anti")
