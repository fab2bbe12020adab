import random

import pytest
from pyspark.sql import functions as F

from numberplace.llm import components as C
from numberplace.llm import jaccard as J
from numberplace.llm.jaccard import jaccard_components

from .conftest import SF, rows_of, words


def shingles(text):
    own = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(own) < 5:
        return {tuple(own)} if own else set()
    return {tuple(own[k : k + 5]) for k in range(len(own) - 4)}


def brute(rows):
    """Components by comparing all pairs of texts; nodes are ids."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and i is not None and j is not None and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=repr)


def test_awkward_rows(awkward_docs, clashing):
    expected = brute([(r.doc_id, r.text) for r in awkward_docs.collect()])
    assert rows_of(jaccard_components(awkward_docs)) == expected
    assert rows_of(jaccard_components(clashing(awkward_docs))) == expected
    assert rows_of(jaccard_components(awkward_docs.limit(0))) == []


def test_near_copies_around_one_text_and_common_passages(spark):
    rng = random.Random(5)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(100)]
    passage = [f"p{k}" for k in range(40)]
    rows = []
    for k in range(120):
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(100)] = f"x{rng.randint(0, 10**6)}"
        rows.append((k, " ".join(own)))
    rows += [(200 + k, " ".join(passage + [f"y{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 30))])) for k in range(80)]
    rows += [(400 + k, " ".join(base)) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(jaccard_components(docs)) == brute(rows)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert rows_of(jaccard_components(docs)) == brute([tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("links", [[], [(1, 1)], [(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 30)] + [(50, 49), (49, 48)]])
def test_components(spark, links):
    parent = {}
    for u, v in links:
        if u != v:
            a, b = parent.setdefault(u, {u}), parent.setdefault(v, {v})
            a |= b
            for x in a:
                parent[x] = a
    found = C.components(spark.createDataFrame(links, "u long, v long"))
    assert sorted(tuple(r) for r in found.collect()) == sorted((x, min(s)) for x, s in parent.items())


def test_a_document_of_several_texts_keeps_the_links_of_each(spark):
    """Id 9 has a copy of 3's text and a text of its own, of which 12 has a near copy."""
    one, two = (" ".join(f"{kind}{k}" for k in range(60)) for kind in "ab")
    df = spark.createDataFrame([(3, one), (9, one), (9, two), (12, two + " end")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard_components(df).collect()} == {3: 3, 9: 3, 12: 3}


def test_documents_that_share_a_passage_are_not_listed_under_it(spark):
    """Of 300 documents with a common half, none is a candidate; the frequent shingles come last."""
    rng = random.Random(8)
    passage = [f"p{k}" for k in range(50)]
    rows = [(k, " ".join(passage + [f"z{rng.randint(0, 10**9)}" for _ in range(50)])) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    listed = J.shingle_sets(docs, "doc_id", "text").collect()
    entries = [x for r in listed for x in r.listed]
    assert len(entries) == sum(r.n - -(-80 * r.n // 100) + 1 + r.n // 20 for r in listed)
    assert len(set(entries)) == len(entries)
    assert J.frequency_levels(docs, "text").max() == 8
    assert rows_of(jaccard_components(docs)) == brute(rows)


def test_any_order_of_shingles_gives_the_same_links(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert rows_of(jaccard_components(docs, counters=11)) == rows_of(jaccard_components(docs))


def test_long_texts_of_which_two_thirds_agree_do_not_meet(spark):
    """Pairs of texts of 800 words with the same 640 in them: their lists are equal, and the sketches tell them apart."""
    rows = [(k, " ".join([f"s{k // 2}_{j}" for j in range(640)] + [f"o{k}_{j}" for j in range(160)])) for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    listed = J.shingle_sets(docs, "doc_id", "text").persist()
    lists = J._lists(listed, listed.limit(0)).withColumn("component", F.col("node"))
    centres = J._centres(lists)
    assert centres.count() > 50
    assert J._remaining(lists, centres, listed.select("node", "sketch"), 80).collect() == []
    assert rows_of(jaccard_components(docs)) == brute(rows)


def test_equal_lists_meet_once(spark):
    """Lists are merged into one only where documents, sizes and what is merged agree; the pairs stay."""
    entries = [(t, node, 100, 5, True, node) for t in (1, 2, 3) for node in (7, 8)]
    entries += [(4, 7, 100, 5, False, 7), (4, 8, 100, 5, True, 8), (5, 8, 100, 5, True, 8), (5, 9, 100, 5, True, 9)]
    lists = spark.createDataFrame(entries, "token long, node long, n long, score long, merged boolean, component long")
    sketches = spark.createDataFrame([(k, [0] * len(J._PARTS)) for k in (7, 8, 9)], "node long, sketch array<long>")
    centres = J._centres(lists)
    assert sorted(r.token for r in J._distinct_lists(centres).collect()) == [1, 4, 5]
    assert rows_of(J._remaining(lists, centres, sketches, 80)) == [(7, 8), (8, 9)]
