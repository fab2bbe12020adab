import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest

from numberplace.llm import phrase_graph as P

from .conftest import rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, longest, least, percent, top):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            own = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(own)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(own[k : k + size]) for k in range(len(own) - size + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in found.items():
            if any(100 * b >= percent * a and len(q) > len(p) and any(q[k : k + len(p)] == p for k in range(len(q)))
                   for q, b in found.items()):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]], paths(found, f, longest).get(p, len(p))))
        for rank, (score, a, phrase, left, right, path) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score, path))
    return sorted(out, key=repr)


def paths(found, f, longest):
    """The words of the path of every longest phrase, walked edge by edge."""
    edges = [p for p in found if len(p) == longest]

    def unary(node):
        heavy = [max([found[e] for e in edges if e[cut] == node], default=0) for cut in (slice(1, None), slice(0, -1))]
        return heavy == [f[node], f[node]]

    after = {e: next(x for x in edges if x[:-1] == e[1:]) for e in edges if unary(e[1:])}
    out = {}
    for e in set(edges) - set(after.values()):
        path = [e]
        while path[-1] in after:
            path.append(after[path[-1]])
        out.update({x: longest + len(path) - 1 for x in path})
    return out


def chance_rows(rng, n):
    passage = [f"p{k}" for k in range(9)]
    rows = []
    for _ in range(n):
        words = [rng.choice(["a", "B", "b", "ü", "Ü", "cc", "the"]) + rng.choice(["", "", ",", ".", "\t", "\n"]) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.4:
            words += passage + [rng.choice("xyz")]
        rows.append((" ".join(words), rng.choice(["en", "de", None, "und"])))
    return rows + [(None, "en"), ("", None), (" .,; ", "fr"), ("the " * 300, "en"), ("x" * 5_000, "de")] * 2


@pytest.mark.parametrize("longest, least, percent, top", [(3, 10, 50, 2_000), (3, 3, 80, 7), (4, 4, 50, 50)])
def test_against_counting_all_phrases(spark, clashing, monkeypatch, longest, least, percent, top):
    monkeypatch.setattr(P, "BATCH_WORDS", 500)
    rows = chance_rows(random.Random(longest * top), 120)
    expected = brute(rows, longest, least, percent, top)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    options = dict(longest=longest, least=least, percent=percent, top=top)
    assert rows_of(P.collocations(clashing(df), **options)) == expected
    assert any(r[-1] > longest for r in expected) and len({r[0] for r in expected}) >= 3


def test_awkward_rows(spark, awkward_docs):
    expected = brute([(r.text, r.lang) for r in awkward_docs.collect()], 3, 10, 50, 2_000)
    assert rows_of(P.collocations(awkward_docs)) == expected and expected
    assert rows_of(P.collocations(awkward_docs.limit(0))) == []
    assert rows_of(P.collocations(awkward_docs.filter("text = 'one'"))) == []


def test_a_pair_in_a_third_of_all_places_is_parted(spark):
    rng = random.Random(4)
    rows = [(f"of the w{rng.randrange(40)}", "en") for _ in range(2_000)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    texts = P._texts(df, "text", "lang")
    hot = P._hot_pairs(texts, 3)
    assert len(hot) and P._graph(texts, 3, hot).filter("salt >= 0").select("salt").distinct().count() > 20
    assert rows_of(P.collocations(df)) == brute(rows, 3, 10, 50, 2_000)


def test_two_words_of_one_hash_fail(spark, monkeypatch):
    monkeypatch.setattr(P, "_spoken", squeezed(P._spoken))
    df = spark.createDataFrame([("a b c, a b c, d e c", "en")] * 30, "text string, lang string")
    with pytest.raises(Exception, match="two words share a hash"):
        P.collocations(df).collect()


def squeezed(spoken):
    """All words in two codes."""
    def few(chunk, langs):
        code, *rest = spoken(chunk, langs)
        return (code % 2 + 1, *rest)

    return few


@pytest.mark.parametrize("rows_per_batch", [1, 7])
def test_a_word_whose_rows_come_in_several_batches(spark, monkeypatch, rows_per_batch):
    """Every task of the first pass has a row of each word; the next one may read them in different batches."""
    monkeypatch.setattr(P, "BATCH_WORDS", 20)
    rows = chance_rows(random.Random(rows_per_batch), 80)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows_per_batch)
    try:
        assert rows_of(P.collocations(df)) == brute(rows, 3, 10, 50, 2_000)
    finally:
        spark.conf.set(name, before)


def test_memory_of_a_batch_of_words():
    """Sorting the edges takes five more columns at most, and rows are handed over in parts."""
    rng, n = np.random.default_rng(3), 200_000
    code = rng.integers(1, 10**9, n).astype(np.uint64)
    piece, lang = np.cumsum(rng.random(n) < 0.1), code % 3
    tracemalloc.start()
    try:
        columns = P.local_graph(code, piece, lang, 3)
        assert tracemalloc.get_traced_memory()[1] < 17 * 8 * n
    finally:
        tracemalloc.stop()
    assert columns[-1][columns[1] != 0].sum() == (piece[1:] == piece[:-1]).sum()


def test_edges_are_handed_over_in_parts(spark, monkeypatch):
    monkeypatch.setattr(P, "OUT_ROWS", 10)
    rows = chance_rows(random.Random(6), 60)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(2)
    assert rows_of(P.collocations(df)) == brute(rows, 3, 10, 50, 2_000)
