"""Collocations mined from a weighted de Bruijn graph of words, per language.

Nodes are word sequences one shorter than the longest phrase, edges the longest
phrases, each from the node it begins with to the node it ends with and as heavy as it
is frequent. Only edges are counted. A piece of text runs out into an end mark: what
passes through a node is the sum of the edges that leave it and of the pieces that end
there, and a shorter phrase is counted by the edges that begin with it, end marks
included. Each task does this for the words of its own part of the graph; pairs of
words and longer phrases are summed where the parts of the graph meet.

Parts meet by their first two words. A pair of words that a thousandth of a sample's
places share is parted further by the third word.

A node that one edge enters and one leaves, with all of its weight, lies inside a unary
path. Paths are compacted by pointer jumping; what lies inside one is covered by its
edges, and ``path_words`` says how far the path goes that a phrase is part of.

Words are told apart by 64-bit hashes salted with their language; those of reported
phrases are spelt in a second pass, which fails if two words share a hash. Text
is taken whole; null texts are empty, a null language counts as ``und``, ids and other
columns play no part, and repeated rows count as often as they are there.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from numberplace.llm import words as W
from numberplace.llm.shared import shared
from numberplace.session import stored

#: Words whose edges a task sorts together, and the rows that it hands over at a time.
BATCH_WORDS, OUT_ROWS = 2_000_000, 100_000
#: Rows of the sample that shows which pairs of words to part, and the share from which on they are.
SAMPLE_ROWS, HOT_SHARE, SALTS = 20_000, 1_000, 64
#: Bits of the filter that keeps words out that are in no reported phrase.
_BITMAP = 1 << 24

UNKNOWN = "und"
_BREAKS = np.zeros(256, bool)
_BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_SOLID = ~_BREAKS
_SOLID[[0x20, 0x09]] = False
_END = np.uint64(0)


def _language_salt(lang: str) -> np.uint64:
    return np.frombuffer(hashlib.blake2b(lang.encode(), digest_size=8).digest(), np.uint64)[0]


def _spoken(chunk: W.Chunk, langs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code, piece, starts, ends, text) of every word of a chunk whose texts are in ``langs``."""
    starts, ends, of = W.pieces(chunk, _SOLID)
    text = np.repeat(np.arange(len(langs)), np.diff(of))
    salts = {lang: _language_salt(lang) for lang in set(langs)}
    salt = np.array([salts[lang] for lang in langs], np.uint64)[text] if len(text) else np.empty(0, np.uint64)
    code = W.mix(W.range_hashes(chunk.data, starts, ends, lower=True) ^ salt)
    code[code == _END] = 1
    breaks = np.concatenate([[0], np.cumsum(_BREAKS[chunk.data])])
    fresh = np.ones(len(starts), np.int64)
    if len(starts):
        fresh[1:] = (breaks[starts[1:]] > breaks[ends[:-1]]) | (text[1:] != text[:-1])
    return code, np.cumsum(fresh), starts, ends, text


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return W.mix(W.mix(first) + second)


def _heads(columns: list[np.ndarray]) -> np.ndarray:
    """Where a row differs from the one before."""
    if not len(columns[0]):
        return np.empty(0, np.int64)
    differ = functools.reduce(np.logical_or, [c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(np.concatenate([[True], differ]))


def local_graph(code: np.ndarray, piece: np.ndarray, lang: np.ndarray, longest: int) -> list[np.ndarray]:
    """Columns w1 to w``longest`` and count: the edges of some words, sorted, and a row (word, end, language) per word.

    An edge that runs beyond its piece has end marks; the word rows add up the flow
    through all nodes that begin with the word, pieces that end with it included.
    """
    columns = [code]
    for k in range(1, longest):
        after = np.full(len(code), _END)
        inside = np.flatnonzero(piece[k:] == piece[: len(piece) - k]) if k < len(piece) else np.empty(0, np.int64)
        after[inside] = code[inside + k]
        columns.append(after)
        del after, inside
    size = len(code)
    order = np.lexsort(columns[::-1])
    del code, piece
    # Columns are replaced one at a time, so that few are held twice.
    _reorder(columns, order)
    lang = lang[order]
    del order
    heads = _heads(columns)
    _reorder(columns, heads)
    counts, lang = np.diff(heads, append=size), lang[heads]
    del heads
    words = _heads(columns[:1])
    flow = np.add.reduceat(counts, words) if len(words) else counts
    kept = columns[1] != _END
    word_rows = [columns[0][words], np.full(len(words), _END), lang[words], *[np.full(len(words), _END)] * (longest - 3)]
    columns.append(counts)
    del lang, words, counts
    for k, own in enumerate([*word_rows, flow]):
        columns[k] = np.concatenate([columns[k][kept], own])
    # In order again: neighbours in the same partition then share bytes.
    _reorder(columns, np.lexsort(columns[-2::-1]))
    return columns


def _reorder(columns: list[np.ndarray], rows: np.ndarray) -> None:
    for k in range(len(columns)):
        columns[k] = columns[k][rows]


def _names(longest: int) -> list[str]:
    return [f"w{k}" for k in range(1, longest + 1)]


def _graph(texts: DataFrame, longest: int, hot: np.ndarray | None = None) -> DataFrame:
    """(salt, w1, ..., count) of ``texts`` (lang, text), summed per task; salt -1 but for the pairs in ``hot``."""
    pairs = shared(texts.sparkSession, hot if hot is not None else np.empty(0, np.uint64))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, size = pairs(), [], 0
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for chunk in W.chunks(batch.column("text")):
                of = langs[chunk.first : chunk.first + len(chunk.bounds) - 1]
                code, piece, _, _, text = _spoken(chunk, of)
                salt = np.array([_language_salt(lang) for lang in of], np.uint64)
                if len(code):
                    held.append((code, (piece + (held[-1][1][-1] if held else 0)).astype(np.int32), salt[text]))
                size += len(code)
                if size >= BATCH_WORDS:
                    yield from rows(held, own)
                    size = 0
        if held:
            yield from rows(held, own)

    def rows(held: list[tuple], own: np.ndarray) -> Iterator[pa.RecordBatch]:
        parts = [np.concatenate(x) for x in zip(*held, strict=True)]
        held.clear()
        columns = local_graph(parts.pop(0), parts.pop(0), parts.pop(0), longest)
        salt = np.full(len(columns[0]), -1, np.int32)
        if len(own):
            split = np.isin(_pair(columns[0], columns[1]), own) & (columns[1] != _END)
            salt[split] = (W.mix(columns[2][split]) % np.uint64(SALTS)).astype(np.int32)
        batch = pa.RecordBatch.from_arrays(
            [pa.array(salt), *(pa.array(c.view(np.int64)) for c in columns)], ["salt", *_names(longest), "count"])
        # The JVM holds what is handed over at a time outside its heap.
        for start in range(0, len(batch), OUT_ROWS):
            yield batch.slice(start, OUT_ROWS)

    return texts.mapInArrow(build, "salt int, " + ", ".join(f"{n} long" for n in [*_names(longest), "count"]))


def _hot_pairs(texts: DataFrame, longest: int) -> np.ndarray:
    """Hashes of the pairs of words at a thousandth of a sample's places or more; this only decides where rows go."""
    rows = texts.count()
    if not rows:
        return np.empty(0, np.uint64)
    sample = stored(_graph(texts.sample(min(1.0, SAMPLE_ROWS / rows), 1), longest).filter("w2 <> 0").groupBy("w1", "w2").agg(
        F.sum("count").alias("n")))
    places = sample.agg(F.sum("n")).first()[0] or 0
    found = sample.filter(F.col("n") * HOT_SHARE >= places).toArrow()  # HOT_SHARE rows at most
    return _pair(*(found[c].to_numpy().astype(np.int64).view(np.uint64) for c in ("w1", "w2")))


def _flows(graph: DataFrame, longest: int, least: int) -> DataFrame:
    """(level, w1, ..., n): phrases of ``level`` words found ``least`` times.

    Level 1 has the word and in w2 its language; level 0 the words of a language (w2),
    in parts; level 2 of a parted pair comes in parts too.
    """
    names = _names(longest)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: dict[int, tuple[list[int], int]] = {}
        for batch in batches:
            salt, *words, count = (batch.column(c).to_numpy() for c in ("salt", *names, "count"))
            if not len(salt):
                continue
            out = []
            for level in range(2, longest + 1):
                heads = _heads([salt, *words[:level]])
                sums = np.add.reduceat(count, heads)
                keys = np.stack([salt[heads], *(w[heads] for w in words)]).astype(np.int64)
                keys[1 + level :] = 0 if level > 2 else keys[1 + level :]
                known = carried.pop(level, None)
                if known is not None and (known[0][: 1 + level] == keys[: 1 + level, 0]).all():
                    sums[0] += known[1]
                    keys[:, 0] = known[0]
                elif known is not None:
                    keys, sums = np.column_stack([known[0], keys]), np.append(known[1], sums)
                carried[level] = keys[:, -1], sums[-1]
                out.append((level, keys[:, :-1], sums[:-1]))
            yield finished(out)
        if carried:
            yield finished([(level, key[:, None], np.array([n])) for level, (key, n) in carried.items()])

    def finished(out: list[tuple]) -> pa.RecordBatch:
        parts: list[np.ndarray] = []
        for level, keys, sums in out:
            salt, first, second, last = keys[0], keys[1], keys[2], keys[level]
            word = second == 0
            if level == 2:
                parts.append(rows(2, keys[:, ~word & ((sums >= least) | (salt >= 0))], sums[~word & ((sums >= least) | (salt >= 0))]))
                often = word & (sums >= least)
                named = np.zeros((longest + 1, often.sum()), np.int64)
                named[1], named[2] = first[often], keys[3][often]
                parts.append(rows(1, named, sums[often]))
                langs, of = np.unique(keys[3][word], return_inverse=True)
                total = np.zeros((longest + 1, len(langs)), np.int64)
                total[2] = langs
                sizes = np.zeros(len(langs), np.int64)
                np.add.at(sizes, of, sums[word])
                parts.append(rows(0, total, sizes))
            else:
                often = ~word & (last != 0) & (sums >= least)
                parts.append(rows(level, keys[:, often], sums[often]))
        table = np.concatenate(parts, axis=1)
        return pa.RecordBatch.from_arrays(
            [pa.array(table[0].astype(np.int32)), *(pa.array(c) for c in table[1:])], ["level", *names, "n"])

    def rows(level: int, keys: np.ndarray, sums: np.ndarray) -> np.ndarray:
        out = np.concatenate([np.full((1, len(sums)), level), keys[1:], sums[None]]).astype(np.int64)
        if level >= 2:
            out[1 + level : -1] = 0
        return out

    dealt = graph.repartition("w1", "w2", "salt").sortWithinPartitions("salt", *names)
    return dealt.mapInArrow(add, "level int, " + ", ".join(f"{c} long" for c in [*names, "n"]))


def phrase_counts(df: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, least: int = 10) -> DataFrame:
    """(level, w1, ..., n), stored: the graph's phrases and words found ``least`` times, and the words per language."""
    if longest < 3:
        raise ValueError("phrases are counted up to three words or more")
    texts = _texts(df, text, lang)
    names = _names(longest)
    flows = stored(_flows(_graph(texts, longest, _hot_pairs(texts, longest)), longest, least))
    whole = flows.filter("level <> 2 AND level <> 0")
    parted = flows.filter("level = 2 OR level = 0").groupBy("level", *names).agg(F.sum("n").alias("n"))
    return stored(whole.unionByName(parted.filter(f"level = 0 OR n >= {least}")))


def _texts(df: DataFrame, text: str, lang: str) -> DataFrame:
    return df.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))


# -- phrases --------------------------------------------------------------------


def _level(counts: DataFrame, level: int) -> DataFrame:
    """(w1, ..., n) of the phrases of one length."""
    return counts.filter(F.col("level") == level).select(*_names(level), "n")


def _part(counts: DataFrame, first: int, last: int, name: str) -> tuple[DataFrame, list[str]]:
    """The counts of a phrase's words ``first`` to ``last``, under ``name``, to join on those words."""
    size = last - first + 1
    on = [f"w{k}" for k in range(first, last + 1)]
    return _level(counts, size).select(*(F.col(f"w{k + 1}").alias(c) for k, c in enumerate(on)), F.col("n").alias(name)), on


def scored(counts: DataFrame, level: int) -> DataFrame:
    """(w1, ..., a, l, r, score) of the phrases of ``level`` words by their lowest cut, in exact arithmetic."""
    out = _level(counts, level).withColumnRenamed("n", "a")
    cuts = []
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    for k in range(1, level):
        for name, first, last in ((f"l{k}", 1, k), (f"r{k}", k + 1, level)):
            part, on = _part(counts, first, last, name)
            out = out.join(part, on)
        out = out.withColumn(f"top{k}", F.lit(1_000_000).cast("decimal(38,0)") * exact("a") * exact("a")).withColumn(
            f"low{k}", (exact(f"l{k}") * exact(f"r{k}")))
        cuts.append(F.struct(F.expr(f"top{k} div low{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    best = F.array_min(F.array(*cuts))
    return out.withColumn("cut", best).select(
        *_names(level), "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").cast("long").alias("score"))


def _through(counts: DataFrame, level: int) -> DataFrame:
    """(w1, ..., into, out): the heaviest phrase one word longer that ends, and that begins, with each phrase of ``level`` words."""
    names = _names(level)
    longer = _level(counts, level + 1)
    begins = longer.select(*names, F.lit(0).cast("long").alias("into"), F.col("n").alias("out"))
    ends = longer.select(*(F.col(f"w{k + 1}").alias(f"w{k}") for k in range(1, level + 1)), F.col("n").alias("into"), F.lit(0).cast("long").alias("out"))
    return begins.unionByName(ends).groupBy(*names).agg(F.max("into").alias("into"), F.max("out").alias("out"))


def uncovered(counts: DataFrame, level: int, percent: int) -> DataFrame:
    """The phrases of ``level`` words of which no longer one has ``percent`` of the count, and that lie inside no unary path.

    A longer phrase is no more frequent than what it consists of, so those of one more word decide.
    """
    phrases = _level(counts, level)
    unary = (F.col("into") == F.col("n")) & (F.col("out") == F.col("n"))
    covered = phrases.join(_through(counts, level), _names(level)).filter(
        unary | (100 * F.greatest("into", "out") >= percent * F.col("n")))
    return phrases.join(covered.select(*_names(level)), _names(level), "left_anti")


def unary_paths(counts: DataFrame, longest: int) -> DataFrame:
    """(w1, ..., path_words): every edge with the length of the compacted path that it lies on, by pointer jumping.

    The jumps double, so a path of m edges takes log2(m) rounds.
    """
    names, node = _names(longest), _names(longest - 1)
    edges = _level(counts, longest)
    inner = _level(counts, longest - 1).join(_through(counts, longest - 1), node).filter("into = n AND out = n")
    tail = inner.select(*(F.col(f"w{k}").alias(f"w{k + 1}") for k in range(1, longest)), F.lit(True).alias("goes_on"))
    onward = edges.join(inner.select(*node), node).select(
        *(F.col(f"w{k}").alias(f"w{k + 1}") for k in range(1, longest)), F.col(f"w{longest}").alias("next_word"))
    # The only edge that leaves an inner node carries all of its weight.
    linked = edges.join(tail, names[1:], "left").join(onward, names[1:], "left")
    own = F.struct(*(F.col(c).alias(c) for c in names))
    after = F.struct(*(F.col(f"w{k + 1}").alias(f"w{k}") for k in range(1, longest)), F.col("next_word").alias(f"w{longest}"))
    jumps = stored(linked.select(
        own.alias("edge"), F.when(F.col("goes_on"), after).otherwise(own).alias("to"),
        F.when(F.col("goes_on"), 1).otherwise(0).cast("long").alias("steps")), open=F.expr("count_if(steps > 0)"))
    jumps, measured = jumps
    still = measured["open"] or 0
    while still:
        onto = jumps.select(F.col("edge").alias("to"), F.col("to").alias("further"), F.col("steps").alias("more"))
        moved = jumps.join(onto, "to").select("edge", F.col("further").alias("to"), (F.col("steps") + F.col("more")).alias("steps"), "more")
        jumps, measured = stored(moved, open=F.expr("count_if(more > 0)"))
        jumps, still = jumps.drop("more"), measured["open"] or 0
    sizes = jumps.groupBy("to").agg((F.max("steps") + longest).alias("path_words"))
    return jumps.join(sizes, "to").select("edge.*", "path_words")


def _spelt(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(code, lang, word) of the words in ``wanted`` (code); a filter of fixed size keeps most others out."""
    bucket = F.pmod(F.col("code"), F.lit(_BITMAP))
    places = wanted.select(bucket.alias("bucket")).groupBy((F.col("bucket") / 64).cast("int").alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(bucket % 64 AS int)))").alias("bits"))
    table = places.toArrow()
    bitmap = np.zeros(_BITMAP // 64, np.int64)
    bitmap[table["at"].to_numpy()] = table["bits"].to_numpy()
    opened = shared(texts.sparkSession, bitmap)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = opened()
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for chunk in W.chunks(batch.column("text")):
                of = langs[chunk.first : chunk.first + len(chunk.bounds) - 1]
                code, _, starts, ends, text = _spoken(chunk, of)
                spot = (code.view(np.int64) % _BITMAP)
                inside = np.flatnonzero((own[spot // 64] >> (spot % 64)) & 1)
                # Each place of a chunk's word once, told apart by the bytes as well, so that a shared hash shows.
                other = W.range_hashes(chunk.data, starts[inside], ends[inside], lower=True) ^ (ends - starts)[inside].astype(np.uint64)
                order = np.lexsort((other, code[inside]))
                inside = inside[order[_heads([code[inside][order], other[order]])]] if len(inside) else inside
                data = chunk.data
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code[inside].view(np.int64)), pa.array([of[k] for k in text[inside]], pa.string()),
                     pa.array([data[a:b].tobytes().lower().decode() for a, b in zip(starts[inside], ends[inside])], pa.string())],
                    ["code", "lang", "word"])

    found = texts.mapInArrow(spell, "code long, lang string, word string").join(wanted, "code")
    said = found.groupBy("code").agg(F.min("lang").alias("lang"), F.min("word").alias("word"), F.max("word").alias("other"))
    return said.select("code", "lang", F.when(F.col("word") == F.col("other"), F.col("word")).otherwise(
        F.raise_error(F.lit("two words share a hash"))).alias("word"))


def collocations(
    df: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, least: int = 10, percent: int = 50, top: int = 2_000
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, path_words): each language's ``top`` phrases of 2 to ``longest`` words.

    ``a``, ``l`` and ``r`` count the phrase and the two parts of its lowest cut, ``n`` the
    language's words; the score is floor(1000000 a a / (l r)). Phrases found fewer than
    ``least`` times, and those of which a longer one has ``percent`` of the count, are left
    out. They come by score, count and spelling.
    """
    texts, names = _texts(df, text, lang), _names(longest)
    counts = phrase_counts(df, text, lang, longest, least)
    parts = []
    for level in range(2, longest + 1):
        phrases = scored(counts, level)
        if level < longest:
            phrases = phrases.join(uncovered(counts, level, percent).select(*_names(level)), _names(level)).withColumn(
                "path_words", F.lit(level).cast("long"))
        else:
            phrases = phrases.join(unary_paths(counts, longest), names)
        missing = {name: F.lit(0).cast("long") for name in names[level:]}
        parts.append(phrases.withColumns(missing) if missing else phrases)
    of = counts.filter("level = 1").select("w1", F.col("w2").alias("salt"))
    found = functools.reduce(DataFrame.unionByName, parts).join(of, "w1")
    # Ties at the end of a list are settled by spelling.
    best = Window.partitionBy("salt").orderBy(F.col("score").desc(), F.col("a").desc())
    chosen = stored(found.withColumn("place", F.rank().over(best)).filter(F.col("place") <= top).drop("place"))
    wanted = stored(chosen.select(F.explode(F.array(*names)).alias("code")).filter("code <> 0").distinct())
    spelt = stored(_spelt(texts, wanted))
    named = chosen
    for k, name in enumerate(names):
        kept = ["lang"] if k == 0 else []
        own = spelt.select(F.col("code").alias(name), F.col("word").alias(f"word{k}"), *kept)
        named = named.join(own, name, "inner" if k == 0 else "left")
    totals = counts.filter("level = 0").select(F.col("w2").alias("salt"), F.col("n"))
    phrase = F.concat_ws(" ", *(F.col(f"word{k}") for k in range(longest)))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = named.join(totals, "salt").withColumn("phrase", phrase).withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "path_words")


_LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def oracle_sql(least: int = 10, percent: int = 50, top: int = 2_000) -> str:
    """DuckDB SQL for phrases of two and three words over ``documents``."""
    return f"""
    WITH RECURSIVE docs AS (
      SELECT coalesce(lang, '{UNKNOWN}') AS lang, translate(coalesce(text, ''), '{_LETTERS[0]}', '{_LETTERS[1]}') AS t FROM documents),
    pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS p FROM docs),
    spoken AS (SELECT lang, list_filter(regexp_split_to_array(p, '[ \\t]+'), lambda x: x <> '') AS ws FROM pieces),
    places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM spoken WHERE len(ws) > 0),
    grams AS (
      SELECT lang, ws[i] AS w1, CASE WHEN i + 1 <= len(ws) THEN ws[i + 1] END AS w2,
             CASE WHEN i + 2 <= len(ws) THEN ws[i + 2] END AS w3 FROM places),
    three AS (SELECT lang, w1, w2, w3, count(*) AS n FROM grams GROUP BY ALL),
    one AS (SELECT lang, w1, sum(n) AS n FROM three GROUP BY ALL),
    words AS (SELECT lang, sum(n) AS n FROM one GROUP BY ALL),
    pairs AS (SELECT lang, w1, w2, sum(n) AS n FROM three WHERE w2 IS NOT NULL GROUP BY ALL HAVING sum(n) >= {least}),
    triples AS (SELECT lang, w1, w2, w3, n FROM three WHERE w3 IS NOT NULL AND n >= {least}),
    through AS (
      SELECT lang, w1, w2, max(o) AS o, max(i) AS i FROM (
        SELECT lang, w1, w2, n AS o, 0 AS i FROM triples UNION ALL SELECT lang, w2, w3, 0, n FROM triples) GROUP BY ALL),
    inner_nodes AS (SELECT p.lang, p.w1, p.w2 FROM pairs p JOIN through t USING (lang, w1, w2) WHERE t.o = p.n AND t.i = p.n),
    links AS (
      SELECT a.lang, a.w1, a.w2, a.w3, b.w3 AS w4 FROM triples a JOIN inner_nodes v ON v.lang = a.lang AND v.w1 = a.w2 AND v.w2 = a.w3
      JOIN triples b ON b.lang = a.lang AND b.w1 = a.w2 AND b.w2 = a.w3),
    walk AS (
      SELECT lang, w1 AS s1, w2 AS s2, w3 AS s3, w1, w2, w3, 3 AS steps FROM triples t WHERE NOT EXISTS (
        SELECT 1 FROM links k WHERE k.lang = t.lang AND k.w2 = t.w1 AND k.w3 = t.w2 AND k.w4 = t.w3)
      UNION ALL
      SELECT w.lang, s1, s2, s3, k.w2, k.w3, k.w4, steps + 1 FROM walk w JOIN links k
        ON k.lang = w.lang AND k.w1 = w.w1 AND k.w2 = w.w2 AND k.w3 = w.w3),
    paths AS (
      SELECT lang, w1, w2, w3, max(steps) OVER (PARTITION BY lang, s1, s2, s3) AS path_words FROM walk),
    cuts AS (
      SELECT p.lang, p.w1 || ' ' || p.w2 AS phrase, p.n AS a, 1 AS k, x.n AS l, y.n AS r, 2 AS path_words
      FROM pairs p JOIN one x ON x.lang = p.lang AND x.w1 = p.w1 JOIN one y ON y.lang = p.lang AND y.w1 = p.w2
      LEFT JOIN through t ON t.lang = p.lang AND t.w1 = p.w1 AND t.w2 = p.w2
      WHERE t.o IS NULL OR 100 * greatest(t.o, t.i) < {percent} * p.n
      UNION ALL
      SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.n, 1, x.n, y.n, h.path_words
      FROM triples t JOIN paths h USING (lang, w1, w2, w3) JOIN one x ON x.lang = t.lang AND x.w1 = t.w1
      JOIN pairs y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
      UNION ALL
      SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.n, 2, x.n, y.n, h.path_words
      FROM triples t JOIN paths h USING (lang, w1, w2, w3) JOIN pairs x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2
      JOIN one y ON y.lang = t.lang AND y.w1 = t.w3),
    scores AS (SELECT *, 1000000::HUGEINT * a::HUGEINT * a::HUGEINT // (l::HUGEINT * r::HUGEINT) AS score FROM cuts),
    lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut FROM scores),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE cut = 1)
    SELECT r.lang, CAST(r.rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r.r AS BIGINT) AS r,
           CAST(w.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score, CAST(path_words AS BIGINT) AS path_words
    FROM ranked r JOIN words w ON w.lang = r.lang WHERE rank <= {top}"""
