import random
from collections import defaultdict

import numpy as np

from numberplace.llm import decontaminate as D

from .conftest import SF, prose, rows_of


def test_wand_finds_what_a_sum_over_all_items_finds(spark):
    rng = random.Random(4)
    items = [(k, prose(rng, rng.randint(3, 60))) for k in range(300)]
    index = next(D.indexes(spark.createDataFrame(items, "item_id long, text string")))
    found = 0
    for trial in range(300):
        words = " ".join(rng.choice(items)[1] for _ in range(2)).split()
        rng.shuffle(words)
        own = D.text_terms(" ".join(words[: rng.randint(1, 60)]))
        query = np.flatnonzero(np.isin(index.vocabulary, own)).tolist()
        sums = defaultdict(float)
        for t in query:
            for i, w in zip(index.items[t], index.weights[t], strict=True):
                sums[i] += w
        expected = sorted(i for i, s in sums.items() if s >= 1 - 1e-9)
        assert [i for i, _ in D.wand(index, query)] == expected
        found += len(expected)
    assert found > 100


def test_essential_terms_lose_nothing(spark):
    rng = random.Random(6)
    items = [(k, prose(rng, rng.randint(5, 50))) for k in range(60)]
    index = next(D.indexes(spark.createDataFrame(items, "item_id long, text string")))
    import pyarrow as pa

    texts = [" ".join([prose(rng, 70), rng.choice(items)[1], prose(rng, rng.randint(0, 300))]) for _ in range(40)]
    for chunk in D.W.chunks(pa.array(texts)):
        found = D.terms(chunk)
        likely = {(t, s) for t, spans in D._likely(index, found).items() for s in spans}
        for text in range(len(texts)):
            first, last = int(found.of[text]), int(found.of[text + 1])
            for start in range(first, last, index.step):
                span = (start, min(start + 2 * index.step, last))
                query = np.flatnonzero(np.isin(index.vocabulary, found.hashes[slice(*span)])).tolist()
                if D.wand(index, query):
                    assert (text, span) in likely


def planted(spark):
    rng = random.Random(8)
    items = [(k, prose(rng, rng.randint(25, 50)) + ". " + prose(rng, 12) + ".") for k in range(30)]
    rows = [(k, prose(rng, rng.randint(0, 400)), "en") for k in range(60)]
    rows += [(100 + k, f"{prose(rng, 90)} {''.join(c.upper() if c.isascii() else c for c in items[k][1])} {prose(rng, 300)}", "en") for k in range(30)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(items, "item_id long, text string")


def test_planted_items_are_found_and_others_left_alone(spark, clashing, monkeypatch):
    docs, items = planted(spark)
    pairs = [(100 + k, k) for k in range(30)]
    assert sorted(tuple(r) for r in D.item_matches(docs, items).select("doc_id", "item_id").collect()) == pairs
    whole = rows_of(D.item_matches(docs, items))
    assert rows_of(D.item_matches(clashing(docs), clashing(items))) == whole
    assert {r.doc_id for r in D.drop_contaminated(docs, items).collect()} == set(range(60))
    monkeypatch.setattr(D, "INDEX_ITEMS", 7)
    assert rows_of(D.item_matches(docs, items)) == whole


def test_repeated_items_are_found_as_if_given_once(spark):
    docs, items = planted(spark)
    docs = docs.filter("doc_id >= 55 AND doc_id < 105")
    whole = rows_of(D.item_matches(docs, items))
    assert len(whole) == 5
    repeated = items.unionByName(items.filter("item_id < 4")).unionByName(items.filter("item_id < 3"))
    assert rows_of(D.item_matches(docs, repeated)) == whole


def test_awkward_rows(spark, awkward_docs):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "! ?"), (None, awkward_docs.filter("doc_id = 10").first().text),
                                   (4, "one"), (4, "two words")], "item_id long, text string")
    found = D.item_matches(awkward_docs, items)
    assert {(r.doc_id, r.item_id) for r in found.collect()} >= {(10, None), (None, None), (3, 4)}
    assert rows_of(D.item_matches(awkward_docs, items.limit(0))) == rows_of(D.item_matches(awkward_docs.limit(0), items)) == []


def test_given_tables(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = {r.item_id: r.text for r in items.collect()}
    expected = {(r.doc_id, i) for r in docs.collect() for i, t in texts.items() if t in r.text}
    assert {(r.doc_id, r.item_id) for r in D.item_matches(docs, items).collect()} == expected


def test_a_long_item_leaves_the_passages_of_others_alone(spark):
    docs, items = planted(spark)
    rng = random.Random(9)
    long = " ".join(f"{prose(rng, 1)}{k}" for k in range(1_500)) + ". The end of it all."
    huge = " ".join(f"{prose(rng, 1)}{k}" for k in range(100_000)) + ". The last of these."
    more = items.union(spark.createDataFrame([(500, long), (501, huge), (502, None), (503, "")], items.schema))
    with_long = docs.union(spark.createDataFrame(
        [(900, f"{prose(rng, 700)} {long} {prose(rng, 90)}", "en"), (901, f"{prose(rng, 40)} {huge}", "en")], docs.schema))
    before = rows_of(D.item_matches(docs, items))
    after = rows_of(D.item_matches(with_long, more))
    assert {r[:2] for r in after} - {r[:2] for r in before} == {(900, 500), (901, 501)}
    assert [r for r in after if r[0] < 900] and [r[:3] for r in after if r[0] < 900] == [r[:3] for r in before]


def test_an_item_is_written_once_and_not_per_term(spark):
    long = " ".join(f"word{k}" for k in range(2_000))
    items = spark.createDataFrame([(1, long)], "item long, text string")
    assert D.item_terms(items).columns == ["item", "term", "tf", "length"] and D.item_terms(items).count() == 2_000
