"""Repeated passages found by suffix trees over prefix groups, and deleted.

A passage is a window of 50 words. It belongs to the least hashed of its eight-word
grams, its anchor, so equal windows have equal anchors at the same place. Suffixes
from anchors on are grouped by prefix, the anchor's gram at first; only groups with
several documents go on. A task builds the subtree of a group: suffixes sorted to the
right of the anchor and, reversed, to its left, with the common lengths of neighbours.
The nodes as deep as a window's right and left part hold all places of that window, and
the least document among them decides.

Groups beyond ``GROUP_ROWS`` get longer prefixes: the windows of an anchor are parted
by where they start, and those that start at one of a few neighbouring places share so
many words that these become the prefix, up to the whole window. There a group holds
nothing but equal windows, and its least document is an aggregate, not a tree. So no
group is taken whole into a task beyond that size, whatever a passage's share of rows.

Documents with equal words are copies: of those of 50 words or more all but the ones
with the smallest id lose every word, and only one stands for them in the groups.

Words are ``[^\\x20\\x09-\\x0D]+``; they are compared by 64-bit hashes at each of the 50
places, whole sequences by 128 bits. A window is repeated if it starts in a document with a
smaller id, so rows of equal id do not count for each other. Rows without an id are
left as they are and do not count. Null and empty texts have no words.

Spark judges by a file's size whether the driver can broadcast it, and windows that
overlap or are equal take a hundredth of their size there. So only the prefixes of large
groups are broadcast, one for ``GROUP_ROWS`` suffixes, and equal windows when counted to be
few; other joins are told to merge.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from numberplace.llm import words as W
from numberplace.session import stored

#: Words in a window and in an anchor's gram.
WINDOW, GRAM = 50, 8
#: Suffixes in a group that one task takes as a tree; some 150 MB of arrays.
GROUP_ROWS = 32_000
#: Suffixes that a task sorts together, of one or of many groups.
TREE_ROWS = 20_000
#: Words in all of the distinct windows that a join broadcasts; 4 MB.
BROADCAST_WORDS = 500_000

_EMPTY = hashlib.sha256(b"").hexdigest()


def _sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` values in a row, by doubling."""
    least, reach = values, 1
    while reach < size:
        step = min(reach, size - reach)
        least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
        reach += step
    return least


def anchors(found: W.Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, first, last, hash): each anchor with the first and last window that belong to it, as word numbers."""
    none = np.empty(0, np.int64)
    grams = W.grams(found.hashes, gram)
    if len(found.hashes) < window:
        return none, none, none, none
    bits = np.uint64((1 << len(grams).bit_length()) - 1)
    # The place stands in the low bits, so the leftmost of equal hashes is the least.
    places = _sliding_min((W.mix(grams) & ~bits) | np.arange(len(grams), dtype=np.uint64), window - gram + 1) & bits
    ends = np.repeat(found.of[1:], np.diff(found.of))
    starts = np.flatnonzero(np.arange(window, len(found.hashes) + 1) <= ends[: len(places)])
    if not len(starts):
        return none, none, none, none
    place = places[starts].astype(np.int64)
    begins = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    lasts = np.append(begins[1:], len(starts)) - 1
    return place[begins], starts[begins], starts[lasts], grams[place[begins]]


def _merged(df: DataFrame) -> DataFrame:
    """``df`` for a join in a shuffle, sorted on both sides, whatever the size of its files."""
    return df.hint("merge")


def _keyed(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """(doc, key, text): rows with equal id and key have equal texts."""
    return df.select(F.col(id_column).alias("doc"), F.xxhash64(text).alias("key"), F.col(text).alias("text"))


def _prints(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """(doc, key, n_words, first, second, sha, hashes): per row its words' number, 128-bit hash and digest, and its anchors."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in W.chunks(batch.column("text")):
                found = W.words(chunk)
                texts = len(chunk.bounds) - 1
                place, _, _, hashes = anchors(found, window, gram)
                other = W.mix(found.hashes ^ np.uint64(0x5851F42D4C957F2D))
                firsts, seconds = (
                    np.array([W.sequence_hash(h[a:b]) for a, b in zip(found.of[:-1], found.of[1:])], np.uint64).view(np.int64)
                    for h in (found.hashes, other))
                data = chunk.data.tobytes()
                shas = [hashlib.sha256(b" ".join(data[a:b].split())).hexdigest() for a, b in zip(chunk.bounds[:-1], chunk.bounds[1:])]
                of = np.searchsorted(place, found.of).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").slice(chunk.first, texts), batch.column("key").slice(chunk.first, texts),
                     pa.array(np.diff(found.of)), pa.array(firsts), pa.array(seconds), pa.array(shas),
                     pa.ListArray.from_arrays(pa.array(of), pa.array(hashes.view(np.int64)))],
                    ["doc", "key", "n_words", "first", "second", "sha", "hashes"])

    return rows.mapInArrow(scan, (
        f"doc {dict(rows.dtypes)['doc']}, key long, n_words long, first long, second long, sha string, hashes array<long>"))


def _suffixes(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """(hash, doc, key, at, place, words): windows ``at`` on that belong to an anchor, with all their words.

    ``rows`` has (doc, key, text, hashes); only anchors in ``hashes`` count. ``place``
    is the anchor's position in ``words``.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = batch.column("hashes").offsets.to_numpy()
            wanted = batch.column("hashes").values.to_numpy().view(np.uint64)
            for chunk in W.chunks(batch.column("text")):
                found = W.words(chunk)
                place, first, last, hashes = anchors(found, window, gram)
                text = np.searchsorted(found.of, place, "right") - 1
                chosen = np.zeros(len(place), bool)
                for k in np.unique(text):
                    own = wanted[offsets[chunk.first + k] : offsets[chunk.first + k + 1]]
                    here = slice(*np.searchsorted(text, [k, k + 1]))
                    chosen[here] = np.isin(hashes[here], own)
                place, first, last, hashes, text = (x[chosen] for x in (place, first, last, hashes, text))
                if not len(place):
                    continue
                sizes = last - first + window
                ends = np.cumsum(sizes)
                spread = np.arange(ends[-1]) - np.repeat(ends - sizes - first, sizes)
                rows = pa.array(text + chunk.first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)), batch.column("doc").take(rows), batch.column("key").take(rows),
                     pa.array(first - found.of[text]), pa.array((place - first).astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(found.hashes[spread].view(np.int64)))],
                    ["hash", "doc", "key", "at", "place", "words"])

    return rows.mapInArrow(cut, f"hash long, doc {dict(rows.dtypes)['doc']}, key long, at long, place int, words array<long>")


def _depths(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """How many columns each row of a matrix, in ``order``, has in common with the one before."""
    sorted_ = rows[order]
    differ = sorted_[1:] != sorted_[:-1]
    return np.concatenate([[0], np.where(differ.any(1), differ.argmax(1), rows.shape[1])])


def _matrix(group: np.ndarray, words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, step: int, width: int) -> np.ndarray:
    """Row per suffix: its group, then up to ``width`` words from ``starts`` on, forward or back, then zeros."""
    out = np.zeros((len(group), width + 1), np.int64)
    out[:, 0] = group
    for k in range(width):
        there = np.flatnonzero(lengths > k)
        out[there, k + 1] = words[starts[there] + step * k]
    return out


def _order(rows: np.ndarray) -> np.ndarray:
    return np.argsort(np.ascontiguousarray(rows).view(f"S{8 * rows.shape[1]}").reshape(-1), kind="stable")


def repeated_windows(
    group: np.ndarray, doc: np.ndarray, words: np.ndarray, bounds: np.ndarray, place: np.ndarray, window: int, gram: int
) -> np.ndarray:
    """Per suffix and start (``window - gram + 1`` columns, by words left of the anchor): is the window in a smaller document of its group?

    ``doc`` are ranks; suffix k has the words ``bounds[k]`` to ``bounds[k + 1]`` with its anchor at ``place[k]``.
    """
    n, starts = len(group), window - gram + 1
    sizes = np.diff(bounds)
    right = _matrix(group, words, bounds[:-1] + place, np.minimum(sizes - place, window), 1, window)
    left = _matrix(group, words, bounds[:-1] + place - 1, np.minimum(place, starts - 1), -1, starts - 1)
    marked = np.zeros((n, starts), bool)
    orders = [_order(right), _order(left)]
    depths = [_depths(m, o) for m, o in zip((right, left), orders)]
    nodes = np.empty((2, n), np.int64)
    for before in range(starts):
        # A window with `before` words left of the anchor; the column of the group counts as one more.
        own = np.flatnonzero((place >= before) & (sizes - place >= window - before))
        if len(own) < 2:
            continue
        for side, depth in ((0, window - before), (1, before)):
            nodes[side, orders[side]] = np.cumsum(depths[side] <= depth)
        node = nodes[0, own] * (n + 1) + nodes[1, own]
        order = np.lexsort((doc[own], node))
        node, rank = node[order], doc[own][order]
        heads = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        least = np.repeat(rank[heads], np.diff(heads, append=len(node)))
        marked[own[order[rank > least]], before] = True
    return marked


def _runs(marked: np.ndarray, place: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffix, first, last) of marked window starts in a row, as word positions in the document."""
    flipped = np.zeros((len(marked), marked.shape[1] + 2), np.int8)
    flipped[:, 1:-1] = marked[:, ::-1]
    change = np.diff(flipped, axis=1)
    suffix, first = np.nonzero(change == 1)
    last = np.nonzero(change == -1)[1] - 1
    base = (at + place - (marked.shape[1] - 1))[suffix]
    return suffix, base + first, base + last


def _trees(suffixes: DataFrame, window: int, gram: int) -> DataFrame:
    """(doc, key, low, high): starts of repeated windows in a row; groups (``prefix``) are taken whole."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) < TREE_ROWS:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            prefix = table.column("prefix").to_numpy()
            # The last group may go on in the next batch.
            cut = int(np.flatnonzero(prefix == prefix[-1])[0])
            if cut:
                yield solved(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
        if sum(map(len, held)):
            yield solved(pa.Table.from_batches(held))

    def solved(table: pa.Table) -> pa.RecordBatch:
        batch = table.combine_chunks().to_batches()[0]
        group = np.unique(batch.column("prefix").to_numpy(), return_inverse=True)[1]
        docs = batch.column("doc")
        rank = np.unique(docs.to_numpy(zero_copy_only=False), return_inverse=True)[1]
        place, at = (batch.column(c).to_numpy().astype(np.int64) for c in ("place", "at"))
        lists = batch.column("words")
        bounds = lists.offsets.to_numpy().astype(np.int64)
        marked = repeated_windows(group, rank, lists.values.to_numpy(), bounds, place, window, gram)
        suffix, low, high = _runs(marked, place, at)
        rows = pa.array(suffix)
        return pa.RecordBatch.from_arrays(
            [docs.take(rows), batch.column("key").take(rows), pa.array(low), pa.array(high)], ["doc", "key", "low", "high"])

    dealt = suffixes.select("prefix", "doc", "key", "at", "place", "words").repartition("prefix").sortWithinPartitions("prefix")
    return dealt.mapInArrow(build, f"doc {dict(suffixes.dtypes)['doc']}, key long, low long, high long")


def _parted(suffixes: DataFrame, width: int, window: int, gram: int) -> DataFrame:
    """The suffixes, each parted by the starts of its windows into ranges of ``width``, with the words common to a range as prefix.

    The prefix of a range from ``low`` to ``high`` words left of the anchor starts ``low``
    words left of it; every window in the range holds it.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("words")
            offsets, words = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy()
            place, at, hashes = (batch.column(c).to_numpy().astype(np.int64) for c in ("place", "at", "hash"))
            least = place - (np.diff(offsets) - window)  # words left of the anchor in the last window
            rows, out = [], []
            for low in range(0, window - gram + 1, width):
                high = min(low + width, window - gram + 1) - 1
                first, last = np.minimum(place, high), np.maximum(least, low)
                for k in np.flatnonzero(last <= first):
                    anchor = offsets[k] + place[k]
                    common = words[anchor - low : anchor + window - high]
                    prefix = W.sequence_hash(np.append(common, [hashes[k], low]).view(np.uint64))
                    rows.append((k, np.uint64(prefix).view(np.int64), at[k] + place[k] - first[k], first[k]))
                    out.append(words[anchor - first[k] : anchor - last[k] + window])
            if not rows:
                continue
            k, prefix, start, own = (np.array(x) for x in zip(*rows, strict=True))
            taken = pa.array(k)
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("hash").take(taken), pa.array(prefix.astype(np.int64)), batch.column("doc").take(taken),
                 batch.column("key").take(taken), pa.array(start.astype(np.int64)), pa.array(own.astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(out)))],
                ["hash", "prefix", "doc", "key", "at", "place", "words"])

    return suffixes.select("hash", "doc", "key", "at", "place", "words").mapInArrow(part, (
        f"hash long, prefix long, doc {dict(suffixes.dtypes)['doc']}, key long, at long, place int, words array<long>"))


def _equal_windows(suffixes: DataFrame, window: int) -> DataFrame:
    """(doc, key, low, high) where a prefix is the whole window; compared word for word."""
    keys = ["prefix", "words"]
    # Stored to be counted, and so that a merge has plain shuffles on both sides, whose skewed partitions Spark can split.
    least = stored(suffixes.groupBy(*keys).agg(F.min("doc").alias("least"), F.max("doc").alias("most")).filter("least < most").drop("most"))
    least = F.broadcast(least) if least.count() * window <= BROADCAST_WORDS else _merged(least)
    return suffixes.join(least, keys).filter("doc > least").select("doc", "key", F.col("at").alias("low"), F.col("at").alias("high"))


def repeated_runs(
    rows: DataFrame, prints: DataFrame, window: int = WINDOW, gram: int = GRAM, group_rows: int | None = None
) -> DataFrame:
    """(doc, key, low, high): runs of starts of windows that also start in a document with a smaller id."""
    most = group_rows or GROUP_ROWS
    listed = prints.filter("size(hashes) > 0").select("doc", "key", F.explode(F.array_distinct("hashes")).alias("hash"))
    shared = listed.groupBy("hash").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low < high").select("hash")
    # A document has no more anchors than words.
    wanted = stored(listed.join(_merged(shared), "hash").groupBy("doc", "key").agg(F.collect_list("hash").alias("hashes")))
    open_ = stored(_suffixes(rows.join(_merged(wanted), ["doc", "key"]).select("doc", "key", "text", "hashes"), window, gram)).withColumn(
        "prefix", F.col("hash"))
    parts, width = [], window - gram + 1
    while True:
        sizes = open_.groupBy("prefix").agg(F.count("*").alias("n"), F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low < high")
        large = stored(sizes.filter(F.col("n") > most).select("prefix"))
        if large.isEmpty():
            parts.append(_trees(open_, window, gram))
            break
        parts.append(_trees(open_.join(large, "prefix", "left_anti"), window, gram))
        width = -(-width // 4)
        open_ = stored(_parted(open_.join(large, "prefix", "left_semi"), width, window, gram))
        if width == 1:
            parts.append(_equal_windows(open_, window))
            break
    return functools.reduce(DataFrame.unionByName, parts)


def _remaining(rows: DataFrame, window: int) -> DataFrame:
    """(doc, n_words, n_removed, kept) of texts with the runs of repeated windows in ``lows`` and ``highs``."""

    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, removed, kept = [], [], []
            for text, lows, highs in zip(batch.column("text").to_pylist(), *(batch.column(c).to_pylist() for c in ("lows", "highs")), strict=True):
                words = text.encode().split()
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, np.array(lows), 1)
                np.add.at(change, np.array(highs) + window, -1)
                covered = np.cumsum(change[:-1]) > 0
                totals.append(len(words))
                removed.append(int(covered.sum()))
                kept.append(b" ".join(words[k] for k in np.flatnonzero(~covered)).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc", "n_words", "n_removed", "kept"])

    return rows.mapInArrow(delete, f"doc {dict(rows.dtypes)['doc']}, n_words long, n_removed long, kept string")


def delete_repeated_passages(
    df: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, group_rows: int | None = None
) -> DataFrame:
    """Per row: the id, ``n_words``, ``n_removed``, ``kept_sha256`` and, where words went, the ``kept`` ones in one text.

    A word goes if a window of ``window`` words that covers it also starts in a
    document with a smaller id, judged on the texts as given.
    """
    rows = _keyed(df, id_column, text)
    prints = stored(_prints(rows, window, gram))
    same = ["first", "second", "n_words"]
    groups = prints.filter(F.col("doc").isNotNull() & (F.col("n_words") >= window)).groupBy(*same).agg(F.min("doc").alias("earliest"), F.count("*").alias("n"))
    marked = stored(prints.join(_merged(groups.filter("n > 1").drop("n")), same, "left"))
    copies = marked.filter("doc > earliest")
    singles = marked.filter("doc IS NULL OR earliest IS NULL OR doc = earliest")
    runs = repeated_runs(rows, singles.filter("doc IS NOT NULL").select("doc", "key", "hashes"), window, gram, group_rows)
    by_text = stored(runs.groupBy("doc", "key").agg(F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs")))
    changed = _remaining(rows.join(_merged(by_text), ["doc", "key"]).select("doc", "text", "lows", "highs"), window)
    out = ["doc", "n_words", "n_removed", "kept_sha256", "kept"]
    parts = [
        copies.select("doc", "n_words", F.col("n_words").alias("n_removed"), F.lit(_EMPTY).alias("kept_sha256"), F.lit("").alias("kept")),
        singles.join(_merged(by_text.select("doc", "key")), ["doc", "key"], "left_anti").select(
            "doc", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"), F.lit(None).cast("string").alias("kept")),
        changed.withColumn("kept_sha256", F.sha2("kept", 256)).select(*out),
    ]
    return functools.reduce(DataFrame.unionByName, parts).withColumnRenamed("doc", id_column)
