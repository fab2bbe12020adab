"""Modified Kneser-Ney models over characters, counted by Spark.

``SPELLING`` takes words one by one: a word is spelt with three start marks
before it and an end mark behind it, its n-grams have four characters.
``RUNNING`` takes a whole text, each run of blanks as one: its n-grams have six
characters and run across words, so it tells a text from its shuffled words.
N-grams are counted per language over whole texts. Lower orders use continuation
counts, each order has its own three discounts. Tasks hold both models as
sorted arrays of 64-bit hashes, which executors hash, sort and pack; they pass the
driver one piece of ``PIECE_ROWS`` rows at a time. They are read from a table in parts of at most
``MODEL_ROWS`` and ``RUNNING_ROWS`` rows or so, one pass over the texts per part (one part, while the
table is no larger): what a position looks up from two characters of context on
depends on these, and parts are cut by them; shorter n-grams are in every part.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from numberplace.llm import words as W
from numberplace.session import HEAP_SHARE, discard, release_memory, stored


class Grams(NamedTuple):
    """N-grams of ``order`` characters packed into ``bits`` bits each; ``kind`` tells their rows in the table."""

    order: int
    bits: int
    kind: int

    def last(self, size: int) -> int:
        """A mask of the last ``size`` characters."""
        return (1 << self.bits * size) - 1


SPELLING, RUNNING = Grams(4, 16, 0), Grams(6, 10, 2)
_MODELS = (SPELLING, RUNNING)
_TOP = max(m.order for m in _MODELS)
_START, _END = 0xFFFE, 0xFFFF
#: Of running text, where the blanks but U+0020 do not occur.
_TEXT_START, _TEXT_END, _BLANK = 0x09, 0x0A, 0x20
#: Rows of either model that tasks hold at a time, 12 bytes each.
MODEL_ROWS, RUNNING_ROWS = 4_000_000, 9_000_000
#: Rows that go through the driver at a time.
PIECE_ROWS = 500_000
#: Distinct n-grams that a counting task gathers before it hands them on.
COUNT_ROWS = 2_000_000
#: Added to ``Grams.kind``.
_PROBABILITY, _BACKOFF = 0, 1
_KINDS, _SIZES = RUNNING.kind + 2, RUNNING.order + 1


class Spelt(NamedTuple):
    """Distinct words of a chunk, the n-grams of each, and which one every word is."""

    grams: np.ndarray
    begins: np.ndarray
    which: np.ndarray
    counts: np.ndarray
    words: W.Words


def spell(chunk: W.Chunk) -> Spelt:
    """Pack the n-grams of the distinct words into 64 bits, 16 for each code point's low bits."""
    found = W.words(chunk)
    ordered = W.order_of(found.hashes)
    heads, counts = W.distinct(found.hashes, ordered)
    at, which = ordered[heads], np.empty(len(ordered), np.int64)
    which[ordered] = np.repeat(np.arange(len(heads)), counts)
    chars, codes = _characters(chunk)
    order = SPELLING.order
    first = chars[found.starts[at]]
    sizes = chars[found.ends[at] - 1] + 1 - first
    begins = np.cumsum(sizes + order) - (sizes + order)
    flat = np.full(int((sizes + order).sum()), _START, np.uint64)
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    flat[np.repeat(begins + order - 1, sizes) + inside] = codes[np.repeat(first, sizes) + inside] & 0xFFFF
    flat[begins + order - 1 + sizes] = _END
    packed = np.zeros(max(0, len(flat) - order + 1), np.uint64)
    for k in range(order):
        packed = (packed << np.uint64(16)) | flat[k : k + len(packed)]
    whole = np.ones(len(packed), bool)
    for k in range(1, order):
        whole[(begins[1:] - k)[begins[1:] - k >= 0]] = False
    return Spelt(packed[whole], np.cumsum(sizes + 1) - (sizes + 1), which, counts, found)


def _characters(chunk: W.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """The character that a byte belongs to, and the code points."""
    heads = (chunk.data & 0xC0) != 0x80
    return np.cumsum(heads) - 1, np.frombuffer(chunk.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)


def _squeezed(codes: np.ndarray) -> np.ndarray:
    """Code points in ten bits: Latin ones as they are, 432 others in a row apart."""
    return np.where(codes < 592, codes, 592 + codes % 432).astype(np.uint64)


def run(chunk: W.Chunk, found: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """The packed n-grams of the texts, and where each text's begin; none for a text without words."""
    order, bits = RUNNING.order, RUNNING.bits
    of = np.zeros(len(found.of), np.int64)
    if not len(found.starts):
        return np.empty(0, np.uint64), of
    chars, codes = _characters(chunk)
    spoken = np.flatnonzero(np.diff(found.of))
    heads, tails = found.of[spoken], found.of[spoken + 1] - 1
    source = chars[found.starts]
    sizes = chars[found.ends - 1] + 1 - source
    lead, trail = np.ones(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    lead[heads], trail[tails] = order - 1, 1
    whole = lead + sizes + trail
    begins = np.cumsum(whole) - whole
    flat = np.full(int(whole.sum()), _BLANK, np.uint64)
    flat[(begins[heads][:, None] + np.arange(order - 1)).ravel()] = _TEXT_START
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    flat[np.repeat(begins + lead, sizes) + inside] = _squeezed(codes[np.repeat(source, sizes) + inside])
    flat[begins[tails] + whole[tails] - 1] = _TEXT_END
    packed = np.zeros(len(flat) - order + 1, np.uint64)
    for k in range(order):
        packed = (packed << np.uint64(bits)) | flat[k : k + len(packed)]
    own = np.ones(len(packed), bool)
    for k in range(1, order):
        own[begins[heads[1:]] - k] = False
    of[spoken + 1] = np.diff(begins[heads], append=len(flat)) - order + 1
    return packed[own], np.cumsum(of)


def _by_language(batch: pa.RecordBatch, language: str, text: str) -> Iterator[tuple[str, np.ndarray, pa.Array]]:
    languages = pc.fill_null(batch.column(language), "").dictionary_encode()
    numbers = languages.indices.to_numpy(zero_copy_only=False)
    for number, name in enumerate(languages.dictionary.to_pylist()):
        rows = np.flatnonzero(numbers == number)
        yield name, rows, batch.column(text).take(pa.array(rows))


def gram_counts(df: DataFrame, language: str, text: str) -> DataFrame:
    """(language, model, gram, n) over all texts; a null language counts as '', ``model`` is the kind of ``Grams``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        sizes: dict[tuple[str, int], int] = {}

        def squeeze(name: tuple[str, int]) -> None:
            keys = np.concatenate([k for k, _ in held[name]])
            counts = np.concatenate([c for _, c in held[name]])
            held[name] = [_summed(keys, counts)]
            sizes[name] = len(held[name][0][0])

        def out(names: list[tuple[str, int]]) -> Iterator[pa.RecordBatch]:
            for name in names:
                squeeze(name)
                keys, counts = held.pop(name)[0]
                in_order = np.argsort(keys)  # neighbours share bytes in the shuffle
                keys, counts = keys[in_order], counts[in_order]
                sizes.pop(name)
                if len(keys):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name[0]]).take(pa.array(np.zeros(len(keys), np.int64))),
                         pa.array(np.full(len(keys), name[1], np.int32)),
                         pa.array(keys.view(np.int64)), pa.array(counts)], ["language", "model", "gram", "n"])

        for batch in batches:
            for name, _, column in _by_language(batch, language, text):
                for chunk in W.chunks(column):
                    spelt = spell(chunk)
                    sizes_of = np.diff(spelt.begins, append=len(spelt.grams))
                    for key, new in (
                        ((name, SPELLING.kind), _summed(spelt.grams, np.repeat(spelt.counts, sizes_of))),
                        ((name, RUNNING.kind), np.unique(run(chunk, spelt.words)[0], return_counts=True)),
                    ):
                        held.setdefault(key, []).append(new)
                        sizes[key] = sizes.get(key, 0) + len(new[0])
                        if sizes[key] > COUNT_ROWS:
                            squeeze(key)
            if sum(sizes.values()) > 2 * COUNT_ROWS:
                yield from out(list(held))
        yield from out(list(held))

    counted = df.select(language, text).mapInArrow(count, "language string, model int, gram long, n long")
    # A task has summed its own n-grams, so nothing is summed again before the shuffle.
    dealt = counted.repartition("language", "model", "gram")
    return dealt.groupBy("language", "model", "gram").agg(F.sum("n").alias("n"))


def _scrambled(grams: np.ndarray) -> np.ndarray:
    """Packed n-grams as hashes (a bijection)."""
    return grams * np.uint64(0x9E3779B97F4A7C15)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct packed n-grams, in no order that means anything, with their summed counts."""
    if not len(keys):
        return keys, counts.astype(np.int64)
    order = W.order_of(_scrambled(keys))
    heads, _ = W.distinct(keys, order)
    return keys[order[heads]], np.add.reduceat(counts[order].astype(np.int64), heads)


def fit(df: DataFrame, language: str = "lang", text: str = "text") -> DataFrame:
    """The model as stored tables together: (language, kind, size, gram, value).

    ``value`` is the log probability of a gram of ``size`` characters, or (kind 1)
    the log weight that a context of ``size`` characters leaves to the lower order.
    A row of size 0 has the probability of an unknown character. The kinds of the
    model of running text are 2 and 3. Both models go through each order together,
    so that the driver has a plan for it only once.
    """
    counts = stored(gram_counts(df, language, text))
    orders = {_TOP: counts.filter(F.col("model").isin([m.kind for m in _MODELS if m.order == _TOP]))}
    for size in range(_TOP - 1, 0, -1):
        suffix = _by_model(size + 1, lambda m, size=size: F.col("gram").bitwiseAND(m.last(size)))
        shorter = stored(orders[size + 1].groupBy("language", "model", suffix.alias("gram")).agg(F.count("*").alias("n")))
        counted = [m.kind for m in _MODELS if m.order == size]
        orders[size] = shorter.unionByName(counts.filter(F.col("model").isin(counted))) if counted else shorter
    discounts = stored(_discounts(orders))
    parts, lower = [], None
    for size in range(1, _TOP + 1):
        off = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        own = discounts.filter(F.col("size") == size)
        rows = orders[size].join(own, ["language", "model"]).select("language", "model", "gram", "n", off.alias("off"))
        if size == 1:
            contexts = stored(rows.groupBy("language", "model").agg(
                F.sum("n").alias("total"), (F.sum("off") / F.sum("n")).alias("left"), F.count("*").alias("kinds")))
            below = F.col("left") / (F.col("kinds") + 1)
            parts.append(_table_rows(contexts, _PROBABILITY, 0, F.lit(0).cast("long"), F.log(below)))
            rows = rows.join(contexts, ["language", "model"]).withColumn("below", below).withColumn("backoff", F.lit(None).cast("double"))
        else:
            rows = _with_context(rows, lower, size)
        # Kept to a float's precision, and above zero for log.
        p = (F.col("n") - F.col("off")) / F.col("total") + F.col("below")
        lower = stored(rows.select("language", "model", "gram", p.alias("p"), "backoff"))
        parts.append(_table_rows(lower, _PROBABILITY, size, F.col("gram"), F.log("p")))
        if size > 1:
            context = _by_model(size, lambda m: F.shiftrightunsigned("gram", m.bits))
            parts.append(_table_rows(lower.filter("backoff IS NOT NULL"), _BACKOFF, size - 1, context, F.col("backoff")))
        if all(m.order != size for m in _MODELS):  # else the counts are among them
            discard(orders[size])
    for model in _MODELS:
        discard(orders[model.order])
    return functools.reduce(DataFrame.unionByName, parts)


def _with_size(size: int) -> list[Grams]:
    """The models that have n-grams of ``size`` characters."""
    return [m for m in _MODELS if m.order >= size]


def _by_model(size: int, value: Callable[[Grams], Column]) -> Column:
    """The value for the model whose kind a row has; the rows are n-grams of ``size`` characters."""
    return F.coalesce(*(F.when(F.col("model") == m.kind, value(m)) for m in _with_size(size)))


def _table_rows(rows: DataFrame, kind: int, size: int, gram: Column, value: Column) -> DataFrame:
    own = (F.col("model") + kind).alias("kind")
    return rows.select("language", own, F.lit(size).alias("size"), gram.alias("gram"), value.alias("value"))


def _with_context(rows: DataFrame, lower: DataFrame, size: int) -> DataFrame:
    """Grams of ``size`` characters with their context's ``total`` and what the lower order adds (``below``).

    One row of each context has the log weight that it leaves, ``backoff``. A gram
    needs what is counted in its context and the probability of the gram without its
    first character. Both share its middle, all but the first and the last
    character, so dealt out by that one shuffle per order serves both.
    """
    middle = _by_model(size, lambda m: F.shiftrightunsigned("gram", m.bits))
    inner = _by_model(size, lambda m: F.shiftrightunsigned("gram", m.bits).bitwiseAND(m.last(size - 2)))
    last = _by_model(size, lambda m: F.col("gram").bitwiseAND(m.last(size - 1)))
    tagged = rows.select("language", "model", "gram", "n", "off", inner.alias("middle"), last.alias("last"),
                         F.lit(None).cast("double").alias("p"))
    known = lower.filter(F.col("model").isin([m.kind for m in _with_size(size)])).select(
        "language", "model", "gram", F.lit(None).cast("long").alias("n"), F.lit(None).cast("double").alias("off"),
        middle.alias("middle"), F.col("gram").alias("last"), "p")
    dealt = tagged.unionByName(known).repartition("language", "model", "middle")
    by_last = Window.partitionBy("language", "model", "middle", "last")
    by_context = Window.partitionBy("language", "model", "middle", "context")
    total, left = F.sum("n").over(by_context), F.sum("off").over(by_context)
    grams = dealt.withColumn("p", F.max("p").over(by_last)).filter("n IS NOT NULL").withColumn("context", middle)
    grams = grams.withColumns({"total": total, "left": left / total, "place": F.row_number().over(by_context.orderBy("gram"))})
    return grams.withColumns({
        "below": F.col("left") * F.col("p"), "backoff": F.when(F.col("place") == 1, F.log("left"))})


def _discounts(orders: dict[int, DataFrame]) -> DataFrame:
    """Three discounts per language, model and size from how many grams occur once to four times."""
    grams = functools.reduce(DataFrame.unionByName, (
        rows.select("language", "model", F.lit(size).alias("size"), "n") for size, rows in orders.items()))
    seen = grams.groupBy("language", "model", "size").agg(
        *(F.sum(F.when(F.col("n") == k, 1).otherwise(0)).alias(f"n{k}") for k in range(1, 5)))
    share = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def discount(k: int) -> Column:
        formula = k - (k + 1) * share * F.col(f"n{k + 1}") / F.nullif(F.col(f"n{k}"), F.lit(0))
        # Where too little was counted the formula has no value; half a count goes then.
        bounded = F.greatest(F.lit(0.1), F.least(formula, F.lit(k - 0.05)))
        usable = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col(f"n{k}") > 0)
        return F.when(usable, bounded).otherwise(F.lit(0.5)).alias(f"d{k}")

    return seen.select("language", "model", "size", *(discount(k) for k in (1, 2, 3)))


def _salt(language: str, kind: int, size: int) -> np.uint64:
    name = hashlib.blake2b(f"{kind}{size}{language}".encode(), digest_size=8)
    return np.frombuffer(name.digest(), np.uint64)[0]


def _keys(language: str, kind: int, size: int, grams: np.ndarray) -> np.ndarray:
    return W.mix(grams.astype(np.uint64) ^ _salt(language, kind, size))


class Model(NamedTuple):
    """Sorted hashes and their values, in pieces one after the other; ``part`` of ``parts`` by the two preceding characters."""

    pieces: list[tuple[np.ndarray, np.ndarray]]
    part: int
    parts: int

    @property
    def hashes(self) -> np.ndarray:
        return np.concatenate([hashes for hashes, _ in self.pieces])

    def find(self, language: str, kind: int, size: int, grams: np.ndarray) -> np.ndarray:
        """Values, NaN where there is none."""
        keys = _keys(language, kind, size, grams)
        order = W.order_of(keys)  # a search in order walks through memory in order
        keys = keys[order]
        out = np.full(len(keys), np.nan, np.float32)
        lasts = np.array([hashes[-1] for hashes, _ in self.pieces], np.uint64)
        begin = 0
        for (hashes, values), end in zip(self.pieces, np.searchsorted(keys, lasts, side="right"), strict=True):
            own = keys[begin:end]
            at = np.searchsorted(hashes, own)
            out[order[begin:end]] = np.where(hashes[at] == own, values[at], np.float32(np.nan))
            begin = end
        return out

    def log_probabilities(self, language: str, grams: np.ndarray, model: Grams = SPELLING) -> np.ndarray:
        """Of each packed gram's last character, 0 for grams of other parts."""
        if self.parts > 1:
            own = np.flatnonzero(_part(grams >> np.uint64(model.bits), self.parts, model) == self.part)
            out = np.zeros(len(grams), np.float32)
            out[own] = self._find_all(language, grams[own], model)
            return out
        return self._find_all(language, grams, model)

    def _find_all(self, language: str, grams: np.ndarray, model: Grams) -> np.ndarray:
        out = self.find(language, model.kind + _PROBABILITY, model.order, grams)
        todo = np.flatnonzero(np.isnan(out))
        paid = np.zeros(len(todo), np.float32)
        for size in range(model.order - 1, -1, -1):
            if not len(todo):
                break
            if size:  # from contexts of `size` characters to grams of `size`
                context = (grams[todo] >> np.uint64(model.bits)) & np.uint64(model.last(size))
                paid += np.nan_to_num(self.find(language, model.kind + _BACKOFF, size, context))
            gram = grams[todo] & np.uint64(model.last(size))
            value = self.find(language, model.kind + _PROBABILITY, size, gram)
            value = np.where(np.isnan(value) & (size == 0), np.float32(-20), value)  # a language never counted
            done = ~np.isnan(value)
            out[todo[done]] = (value + paid)[done]
            todo, paid = todo[~done], paid[~done]
        return out


def _part(contexts: np.ndarray, parts: int, model: Grams) -> np.ndarray:
    """By the last two characters; the prime spreads the one before over the parts."""
    before = (contexts >> np.uint64(model.bits)) & np.uint64(model.last(1))
    return ((contexts & np.uint64(model.last(1))) * np.uint64(8191) + before) % np.uint64(parts)


def _rows_of(model: Grams, part: int, parts: int) -> Column:
    """Whether a row is of this model and part; what has less than two characters of context is in all."""
    backoff = F.col("kind") == model.kind + _BACKOFF
    context = F.when(backoff, F.col("gram")).otherwise(F.shiftrightunsigned("gram", model.bits))
    everywhere = F.col("size") < F.when(backoff, 2).otherwise(3)
    before = F.shiftrightunsigned(context, model.bits).bitwiseAND(model.last(1))
    number = (context.bitwiseAND(model.last(1)) * 8191 + before) % parts
    return (backoff | (F.col("kind") == model.kind + _PROBABILITY)) & (everywhere | (number == part))


def part_count(model: DataFrame) -> int:
    """How many parts the stored model takes."""
    rows = model.agg(F.count_if(F.col("kind") < RUNNING.kind).alias("spelt"), F.count_if(F.col("kind") >= RUNNING.kind).alias("run")).first()
    return max(1, -(-rows.spelt // MODEL_ROWS), -(-rows.run // RUNNING_ROWS))


def hashed(model: DataFrame) -> DataFrame:
    """(hash, value) of the rows of a stored model; the hash tells language, kind, size and gram."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, size = batch.column("kind").to_numpy(), batch.column("size").to_numpy()
            gram = batch.column("gram").to_numpy().view(np.uint64)
            language = batch.column("language").dictionary_encode()
            salts = np.array([[[_salt(name, k, s) for s in range(_SIZES)] for k in range(_KINDS)] for name in language.dictionary.to_pylist()])
            salt = salts[language.indices.to_numpy(zero_copy_only=False), kind, size] if len(batch) else gram
            yield pa.RecordBatch.from_arrays(
                [pa.array(W.mix(gram ^ salt).view(np.int64)), batch.column("value").cast(pa.float32())], ["hash", "value"])

    return model.select("language", "kind", "size", "gram", "value").mapInArrow(keys, "hash long, value float")


def _pieces(model: DataFrame, part: int, parts: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """One part of the stored model as sorted hashes and values, a range of hashes after the other."""
    own = model.filter(functools.reduce(Column.__or__, (_rows_of(m, part, parts) for m in _MODELS)))
    # Hashes are compared as unsigned numbers.
    unsigned = F.col("hash").bitwiseXOR(F.lit(-(2**63)))
    ranges = max(1, -(-own.count() // PIECE_ROWS))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if len(batch)]
        if held:
            table = pa.Table.from_batches(held)
            packed = [[table[name].to_numpy().tobytes()] for name in ("hash", "value")]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in packed], ["hashes", "items"])

    rows = hashed(own).repartitionByRange(ranges, unsigned).sortWithinPartitions(unsigned)
    for row in rows.mapInArrow(pack, "hashes binary, items binary").toLocalIterator(prefetchPartitions=True):
        yield np.frombuffer(row.hashes, np.uint64), np.frombuffer(row.items, np.float32)


def load(model: DataFrame, part: int, parts: int) -> Model:
    """One part of the stored model in this process."""
    return Model(list(_pieces(model, part, parts)), part, parts)


@contextmanager
def sent(model: DataFrame, part: int, parts: int) -> Iterator[Callable[[], Model]]:
    """Broadcast one part of the stored model, piece by piece, and give what gives it back in a task.

    At the end driver and executors forget it: results are to be stored before.
    """
    context = model.sparkSession.sparkContext
    pieces = [tuple(map(context.broadcast, piece)) for piece in _pieces(model, part, parts)]
    try:
        yield lambda: Model([(hashes.value, values.value) for hashes, values in pieces], part, parts)
    finally:
        for broadcast in itertools.chain(*pieces):
            broadcast.destroy()
        release_memory(model.sparkSession, HEAP_SHARE)


def word_scores(model: Model, language: str, chunk: W.Chunk) -> tuple[np.ndarray, W.Words]:
    """The log probability of every word of a chunk."""
    spelt = spell(chunk)
    if not len(spelt.grams):
        return np.empty(0), spelt.words
    logs = model.log_probabilities(language, spelt.grams).astype(np.float64)
    return np.add.reduceat(logs, spelt.begins)[spelt.which], spelt.words


def text_scores(model: Model, language: str, chunk: W.Chunk, found: W.Words) -> np.ndarray:
    """The log probability of every text of a chunk as running text, 0 without words."""
    grams, of = run(chunk, found)
    order = W.order_of(_scrambled(grams))
    heads, counts = W.distinct(grams, order)
    logs, sums = np.empty(len(grams), np.float32), np.zeros(len(grams) + 1)
    logs[order] = np.repeat(model.log_probabilities(language, grams[order[heads]], RUNNING), counts)
    np.cumsum(logs, dtype=np.float64, out=sums[1:])
    return sums[of[1:]] - sums[of[:-1]]
