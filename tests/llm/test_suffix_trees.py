import hashlib
import random
import re

import pytest

from numberplace.llm import queries as Q
from numberplace.llm import suffix_trees as S

from .conftest import SF, rows_of, words


def brute(rows, window=50):
    """(doc_id, n_words, n_removed, digest), sorted, by the least document of each window."""
    least = {}
    for doc, text in rows:
        own = words(text)
        for k in range(len(own) - window + 1) if doc is not None else ():
            least[tuple(own[k : k + window])] = min(doc, least.get(tuple(own[k : k + window]), doc))
    out = []
    for doc, text in rows:
        own = words(text)
        gone = set()
        for k in range(len(own) - window + 1) if doc is not None else ():
            if least[tuple(own[k : k + window])] < doc:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        out.append((doc, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df, **options):
    return rows_of(S.delete_repeated_passages(df, **options).select("doc_id", "n_words", "n_removed", "kept_sha256"))


def test_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    expected = brute(rows)
    assert rows_of(Q.op13_substring_dedup(spark, SF)) == expected and sum(r[2] > 0 for r in expected) > 5


def test_awkward_rows(spark, awkward_docs, clashing):
    expected = brute([(r.doc_id, r.text) for r in awkward_docs.collect()])
    assert any(r[2] for r in expected)
    assert found(awkward_docs) == expected
    assert found(clashing(awkward_docs)) == expected
    assert found(awkward_docs.limit(0)) == []


@pytest.mark.parametrize("group_rows", [3, 40, 4_000])
def test_passages_by_chance(spark, group_rows):
    """A few words only, so that windows overlap themselves and meet in many ways; large groups get longer prefixes."""
    rng = random.Random(group_rows)
    pool = [[rng.choice("abcde") * rng.randint(1, 2) for _ in range(rng.randint(5, 60))] for _ in range(8)]
    rows = []
    for doc in range(60):
        text = [w for _ in range(rng.randint(0, 6)) for w in rng.choice(pool)]
        if rng.random() < 0.5 and text:
            text[rng.randrange(len(text))] = f"own{doc}"
        rows.append((str(doc % 57), " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id string, text string").repartition(5)
    for window, gram in ((50, 8), (12, 3)):
        expected = brute(rows, window)
        assert found(df, window=window, gram=gram, group_rows=group_rows) == expected and any(r[2] for r in expected)


def test_a_passage_of_a_third_of_all_rows(spark):
    rng = random.Random(3)
    passage = " ".join(f"p{k}" for k in range(64))
    rows = [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) + (f" {passage} end{k}" if k % 3 == 0 else "")) for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert found(df, group_rows=50) == brute(rows)


def test_kept_text(spark):
    passage = " ".join(f"p{k}" for k in range(55))
    df = spark.createDataFrame([(1, passage), (2, f"before\n{passage}  after"), (3, passage), (4, "short")], "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in S.delete_repeated_passages(df).collect()}
    assert kept == {1: None, 2: "before after", 3: "", 4: None}


@pytest.mark.parametrize(("words", "kind"), [(0, "SortMergeJoin"), (500_000, "BroadcastHashJoin")])
def test_what_grows_is_not_broadcast(spark, monkeypatch, words, kind):
    """Equal windows fill the driver although their files are small, so counts and not file sizes decide."""
    monkeypatch.setattr(S, "BROADCAST_WORDS", words, raising=False)
    rng = random.Random(5)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(20)) + f" {passage} end{k}") for k in range(200)]
    plans = []

    def planned(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    stored = S.stored
    monkeypatch.setattr(S, "stored", lambda df, **measures: stored(planned(df), **measures))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(planned(S.delete_repeated_passages(df, group_rows=20).select("doc_id", "n_words", "n_removed", "kept_sha256"))) == brute(rows)
    joins = [j for plan in plans for j in re.findall(r"(BroadcastHashJoin|SortMergeJoin)(?:\(\w+=\w+\))? \[([^]]*)\], \[[^]]*\], (\w+)", plan)]
    # The first prefix is the hash of the anchor's gram.
    small = [j for j in joins if re.fullmatch(r"(hash|prefix)#\d+L", j[1]) and j[2] in ("LeftSemi", "LeftAnti")]
    equal = [j for j in joins if re.fullmatch(r"prefix#\d+L, words#\d+", j[1])]
    others = [j[0] for j in joins if j not in small and j not in equal]
    assert len(small) >= 4 and [j[0] for j in equal] == [kind]
    assert len(others) >= 5 and set(others) == {"SortMergeJoin"}
