"""Documents linked by the Jaccard similarity of their word shingles, by T-occurrence search.

Shingles are ordered by how often they occur, as a sketch of counters of fixed size
tells, then by hash; any order that is the same everywhere gives the same links.
A document of n shingles is listed under its first n - ceil(0.8 n) + T, with
T = 1 + n / 20: two linked documents have at least T of the smaller one's listed
shingles in common. As the frequent ones come last, documents that only share a
passage are not listed under it, however many they are.

As in DivideSkip, a document leaves out its T - 1 longest lists and merges the
others with all the documents in them, so it meets each partner at least once.
The left-out lists are then probed: a binary search finds the listed shingles of
the one document among the other's, and candidates with fewer than T in common go.
The rest are compared as whole sets.

Only the components of the links are asked for. So each list first meets its
most central document (whose shingles are the most frequent), and once that has
been turned into components, only pairs from different components meet. A list
that copies of one text fill costs as many pairs as it has entries. Of lists with the same
entries, such as those of a passage that the same documents hold, one is merged for all.
Pairs that still meet are tested by sketches of ``SKETCH_BITS`` parity bits first: as many
bits as differ, so many shingles at least are in one set only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from numberplace.llm import words as W
from numberplace.llm.components import components
from numberplace.llm.shared import shared
from numberplace.session import discard, stored

#: Words in a shingle; the least similarity in percent.
SHINGLE, PERCENT = 5, 80
#: Bits of the filter that keeps uninvolved texts out.
_BITMAP = 1 << 24
#: Counters of the frequency sketch, as a power of two, and how many of them travel in a row.
COUNTERS, _ROW = 21, 2048
#: A document has to share one shingle and one more for each so many that it has.
_STEP = 20
#: Parity bits of a set, a power of two; the more there are, the larger the sets that they still tell apart.
SKETCH_BITS = 1024
_PARTS = [f"s{k}" for k in range(SKETCH_BITS // 64)]


def frequency_levels(df: DataFrame, text: str, size: int = SHINGLE, counters: int = COUNTERS) -> np.ndarray:
    """Per counter, the binary logarithm of how many shingles of all texts fall on it.

    Every task sends its counters in rows of fixed size, which are added up in a
    shuffle as they come; the driver gets one byte per counter.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << counters, np.int64)
        for batch in batches:
            for chunk in W.chunks(batch.column(text)):
                np.add.at(counts, _counter(W.grams(W.words(chunk, lower=True).hashes, size), counters), 1)
        yield from _rows(dict(enumerate(counts.reshape(-1, _ROW))))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
                own = np.frombuffer(pa.decompress(packed.as_buffer(), 8 * _ROW, "zstd"), np.int64)
                sums[part] = sums[part] + own if part in sums else own
        yield from _rows({part: np.log2(1 + own).astype(np.int64) for part, own in sums.items()})

    schema = "part int, counts binary"
    table = df.select(text).mapInArrow(count, schema).repartition("part").mapInArrow(add, schema).toArrow()
    levels = np.zeros((1 << counters) // _ROW * _ROW, np.uint8).reshape(-1, _ROW)
    for part, packed in zip(table["part"].to_pylist(), table["counts"], strict=True):
        levels[part] = np.frombuffer(pa.decompress(packed.as_buffer(), 8 * _ROW, "zstd"), np.int64)
    return levels.reshape(-1)


def _counter(hashes: np.ndarray, counters: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - counters)).astype(np.int64)


def _rows(counts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    packed = [pa.compress(np.ascontiguousarray(x).tobytes(), "zstd", asbytes=True) for x in counts.values()]
    yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int32()), pa.array(packed, pa.binary())], ["part", "counts"])


def shingles(found: W.Words, text: int, size: int) -> np.ndarray:
    """The sorted distinct shingle hashes of one text of a chunk."""
    own = found.hashes[found.of[text] : found.of[text + 1]]
    if not len(own):
        return own
    if len(own) < size:
        return W.sequence_hash(own)[None]
    return np.unique(W.grams(own, size))


def shingle_sets(
    df: DataFrame, id_column: str, text: str, size: int = SHINGLE, percent: int = PERCENT, counters: int = COUNTERS
) -> DataFrame:
    """(node, n, first, second, sketch, listed): the set's size, a 128-bit hash, parity bits, and the listed shingles, sorted."""
    opened = shared(df.sparkSession, frequency_levels(df, text, size, counters))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = opened()
        for batch in batches:
            for chunk in W.chunks(batch.column(text)):
                found = W.words(chunk, lower=True)
                texts = len(chunk.bounds) - 1
                sizes, listed = np.zeros(texts, np.int64), []
                hashes, sketches = np.zeros((2, texts), np.uint64), np.zeros((texts, SKETCH_BITS), bool)
                for k in range(texts):
                    own = shingles(found, k, size)
                    n = sizes[k] = len(own)
                    spread = W.mix(own ^ np.uint64(0x5851F42D4C957F2D))
                    hashes[:, k] = own.sum(dtype=np.uint64), spread.sum(dtype=np.uint64)
                    sketches[k] = np.bincount(_counter(spread, SKETCH_BITS.bit_length() - 1), minlength=SKETCH_BITS) & 1
                    rare = np.argsort(levels[_counter(own, counters)], kind="stable")
                    listed.append(np.sort(own[rare[: n - -(-percent * n // 100) + 1 + n // _STEP]].view(np.int64)).view(np.uint64))
                bits = np.packbits(sketches, axis=1).reshape(-1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(id_column).slice(chunk.first, texts), pa.array(sizes),
                     *(pa.array(h.view(np.int64)) for h in hashes),
                     pa.ListArray.from_arrays(pa.array(np.arange(texts + 1) * len(_PARTS), pa.int32()), pa.array(bits)),
                     _arrays(listed)],
                    ["node", "n", "first", "second", "sketch", "listed"])

    kind = dict(df.dtypes)[id_column]
    return df.select(id_column, text).mapInArrow(
        sets, f"node {kind}, n long, first long, second long, sketch array<long>, listed array<long>")


def _arrays(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(parts).view(np.int64)))


def whole_sets(df: DataFrame, nodes: DataFrame, id_column: str, text: str, size: int = SHINGLE) -> DataFrame:
    """(node, n, shingles) of the documents in ``nodes`` (node).

    A bitmap of fixed size keeps most other texts out before anything is shuffled.
    """
    bucket = lambda column: F.pmod(F.xxhash64(column), F.lit(_BITMAP))
    places = nodes.select(bucket("node").alias("bucket")).groupBy((F.col("bucket") / 64).cast("int").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(bucket % 64 AS int)))").alias("bits"))
    table = places.toArrow()
    bitmap = np.zeros(_BITMAP // 64, np.int64)
    bitmap[table["word"].to_numpy()] = table["bits"].to_numpy()
    opened = shared(df.sparkSession, bitmap)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_bitmap = opened()
        for batch in batches:
            buckets = batch.column("bucket").to_numpy()
            inside = np.flatnonzero((own_bitmap[buckets // 64] >> (buckets % 64)) & 1)
            if not len(inside):
                continue
            batch = batch.take(pa.array(inside))
            for chunk in W.chunks(batch.column("text")):
                found = W.words(chunk, lower=True)
                parts = [shingles(found, k, size) for k in range(len(chunk.bounds) - 1)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(chunk.first, len(parts)), pa.array([len(x) for x in parts], pa.int64()),
                     _arrays(parts)], ["node", "n", "shingles"])

    kind = dict(df.dtypes)[id_column]
    named = df.filter(F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("node"), F.col(text).alias("text"), bucket(id_column).alias("bucket"))
    return named.mapInArrow(sets, f"node {kind}, n long, shingles array<long>").join(nodes, "node", "left_semi")


#: What two rows with equal shingles share.
_SAME = ["first", "second", "n"]


def _lists(listed: DataFrame, copies: DataFrame) -> DataFrame:
    """Stored list entries (token, node, n, score, merged), without the texts in ``copies``.

    Lists of one document are left out. ``merged`` is false for the T - 1 longest
    lists of a document, ``score`` is the summed length of all its lists.
    """
    entries = listed.select("node", "n", F.explode("listed").alias("token"))
    lengths = stored(entries.groupBy("token").agg(F.count("*").alias("length")).filter("length > 1"))
    # A document of several texts goes on with those that are no copies.
    kept = listed.join(copies.select(*_SAME, "node"), [*_SAME, "node"], "left_anti")
    met = kept.select("node", "n", F.explode("listed").alias("token")).join(lengths, "token")
    # A document has no more entries than listed shingles.
    by_node = met.groupBy("node", "n").agg(F.sort_array(F.collect_set(F.struct("length", "token")), asc=False).alias("own"))
    scored = by_node.withColumn("score", F.aggregate("own", F.lit(0).cast("long"), lambda sum_, x: sum_ + x.length))
    spread = scored.select("node", "n", "score", F.posexplode("own").alias("position", "entry"))
    lists = stored(spread.select(
        F.col("entry.token").alias("token"), "node", "n", "score",
        (F.col("position") >= F.floor(F.col("n") / _STEP)).alias("merged")))
    discard(lengths)
    return lists


def _probed(pairs: DataFrame, listed: DataFrame, percent: int) -> DataFrame:
    """Those of the (u, v) that have at least T listed shingles in common, T being that of the smaller document."""
    left = listed.select(F.col("node").alias("u"), F.col("n").alias("m"), F.col("listed").alias("own"))
    right = listed.select(F.col("node").alias("v"), "n", F.col("listed").alias("others"))
    joined = pairs.join(left, "u").join(right, "v").filter(f"({_fits('m', 'n', percent)}) OR ({_fits('n', 'm', percent)})")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = 1 + np.minimum(batch.column("m").to_numpy(), batch.column("n").to_numpy()) // _STEP
            found = np.zeros(len(batch), bool)
            for k, (own, others) in enumerate(zip(batch.column("own"), batch.column("others"), strict=True)):
                short, long = sorted((own.values.to_numpy(), others.values.to_numpy()), key=len)
                at = np.minimum(np.searchsorted(long, short), len(long) - 1)
                found[k] = (long[at] == short).sum() >= least[k]
            yield batch.select(["u", "v"]).filter(pa.array(found))

    kind = dict(pairs.dtypes)["u"]
    return joined.select("u", "v", "m", "n", "own", "others").mapInArrow(probe, f"u {kind}, v {kind}").distinct()


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct (u, v) whose whole sets are similar enough."""
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"), F.col("n").alias("m"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"), "n")
    both = F.size(F.array_intersect("a", "b"))
    joined = pairs.join(left, "u").join(right, "v")
    return joined.filter(100 * both >= percent * (F.col("m") + F.col("n") - both)).select("u", "v")


def _fits(small: str, large: str, percent: int) -> str:
    return f"{small} <= {large} AND {percent} * {large} <= 100 * {small}"


def jaccard_components(
    df: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT,
    counters: int = COUNTERS,
) -> DataFrame:
    """Per row: the id, ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    Words are as in ``words``, with A-Z in lower case; a text of fewer than ``size``
    words is one shingle, a text without words (or a null) links with nothing.
    Rows of equal id are one document with several texts. Rows with a null id are
    linked with nothing and keep a null component. Other columns play no part.
    ``counters`` is the binary logarithm of how many counters order the shingles; the
    more text there is, the more of them tell frequent shingles from the rest.
    """
    listed = stored(shingle_sets(df, id_column, text, size, percent, counters))
    known = listed.filter("n > 0 AND node IS NOT NULL")
    firsts = stored(known.groupBy(*_SAME).agg(F.min("node").alias("copy_of")))
    copies = stored(known.select("node", *_SAME).join(firsts, _SAME).filter("node <> copy_of").distinct())
    lists = _lists(known, copies).withColumn("component", F.col("node"))

    def checked(candidates: DataFrame) -> DataFrame:
        pairs = stored(_probed(candidates, known.select("node", "n", "listed"), percent))
        nodes = stored(pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct())
        sets = stored(whole_sets(df, nodes, id_column, text, size))
        similar = stored(_similar(pairs, sets, percent))
        discard(sets)
        return similar

    found = checked(_central_pairs(lists, percent))
    parts = stored(components(found))
    before = lists
    lists = stored(lists.drop("component").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node")))
    discard(before)
    found = found.unionByName(checked(_remaining(lists, _centres(lists), known.select("node", "sketch"), percent)))
    links = found.unionByName(copies.select(F.col("node").alias("u"), F.col("copy_of").alias("v")))
    final = stored(components(links))
    return listed.select("node", "n").join(final, "node", "left").select(
        F.col("node").alias(id_column), F.col("n").alias("n_shingles"),
        F.coalesce("component", "node").alias("component_id"))


def _central_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """(u, v): each document with the central document that it meets in most of its merged lists, if in a fair share of them."""
    near = f"({_fits('n', 'centre_n', percent)}) OR ({_fits('centre_n', 'n', percent)})"
    meets = lists.filter("merged").join(_centres(lists), "token").filter(f"node <> centre AND ({near})")
    shared = meets.groupBy("node", "centre").agg(F.count("*").alias("lists"), F.first("n").alias("n"))
    best = shared.groupBy("node", "n").agg(F.max(F.struct("lists", "centre")).alias("best"))
    # A document merges about n / 5 lists; in near copies, up to half of these hold none but its own changes.
    return best.filter("best.lists >= n / 20").select(F.col("node").alias("u"), F.col("best.centre").alias("v"))


def _centres(lists: DataFrame) -> DataFrame:
    """Of every list with several components, the most central document, and hashes of its entries with their number."""
    best = F.max_by(F.struct("node", "n", "component"), F.struct("score", "node"))
    # A document has one entry in a list for each size of its texts.
    same = [F.bit_xor(F.xxhash64(F.lit(k), "node", "n", "merged")).alias(f"same{k}") for k in range(2)]
    open_ = lists.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), best.alias("best"), *same,
        F.count("*").alias("entries")).filter("low < high")
    return stored(open_.select("token", F.col("best.node").alias("centre"), F.col("best.n").alias("centre_n"),
                               F.col("best.component").alias("centre_component"), "same0", "same1", "entries"))


def _distinct_lists(centres: DataFrame) -> DataFrame:
    """(token, centre_component) of one list of each set of equal ones, which have the same pairs."""
    one = centres.groupBy("same0", "same1", "entries").agg(F.min(F.struct("token", "centre_component")).alias("one"))
    return one.select("one.*")


def _remaining(lists: DataFrame, centres: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a list which the smaller document merges, and that their sketches allow.

    Entries of the central document's component meet only the entries outside it.
    """
    still = stored(lists.join(_distinct_lists(centres), "token").select(
        "token", "node", "n", "merged", "component", (F.col("component") == F.col("centre_component")).alias("central")))
    bits = [F.col("sketch")[k].alias(name) for k, name in enumerate(_PARTS)]
    sketches = sketches.join(still.select("node").distinct(), "node", "left_semi").select("node", *bits)
    still = stored(still.join(sketches, "node"))
    small = still.select("token", F.col("node").alias("u"), F.col("n").alias("m"), "merged", F.col("component").alias("c"),
                         "central", *(F.col(name).alias(f"t_{name}") for name in _PARTS))
    large = still.select("token", F.col("node").alias("v"), "n", "component", F.col("central").alias("other"), *_PARTS)
    differ = " + ".join(f"bit_count({name} ^ t_{name})" for name in _PARTS)
    rule = (f"{_fits('m', 'n', percent)} AND merged AND c <> component AND (m < n OR u < v) "
            f"AND {100 + percent} * (m + n - ({differ})) >= {2 * percent} * (m + n)")
    outer = small.filter("merged AND NOT central").join(large, "token").filter(rule)
    inner = small.filter("merged AND central").join(large.filter("NOT other"), "token").filter(rule)
    return outer.select("u", "v").unionByName(inner.select("u", "v")).distinct()
