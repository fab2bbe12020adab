import random
import zlib

import numpy as np
import pytest

from numberplace.llm import toxicity as T

from .conftest import prose, rows_of


def sample(rng, n, stems):
    texts, labels = [], []
    for k in range(n):
        words = prose(rng, rng.randint(8, 120)).split()
        if k % 5 == 0:
            for _ in range(max(1, len(words) // 40)):
                words[rng.randrange(len(words))] = rng.choice(stems) + rng.choice(["", "er", "ing", "o", "ly", "s"])
        texts.append(" ".join(words))
        labels.append(int(k % 5 == 0))
    return texts, np.array(labels)


@pytest.fixture(scope="module")
def model():
    return T.fit(*sample(random.Random(1), 1_500, ["scumbag", "worthless", "grubwit"]))


def logits(model, texts):
    import pyarrow as pa

    return np.concatenate([T.text_logits(model, T.bags(c)) for c in T.W.chunks(pa.array(texts))])


def test_held_out_texts_and_misspellings(model):
    texts, labels = sample(random.Random(2), 600, ["scumbag", "worthless", "grubwit"])
    found = logits(model, texts) > np.log(0.7 / 0.3)
    assert (found == labels).mean() > 0.97
    texts, labels = sample(random.Random(3), 400, ["scumbagg", "wworthless", "grubwitt"])
    found = logits(model, texts) > np.log(0.7 / 0.3)
    assert found[labels == 1].mean() > 0.8 and found[labels == 0].mean() < 0.03


def test_buckets_are_those_of_each_term(model):
    import pyarrow as pa

    bag = T.bags(next(T.W.chunks(pa.array(["abc Abc abcd x", "", "abcd"]))))
    sizes = np.diff(bag.begins, append=len(bag.buckets))
    assert sorted(sizes) == [1, 2, 4] and list(bag.of) == [0, 4, 4, 5]
    assert bag.which[0] == bag.which[1] and bag.which[2] == bag.which[4]


def test_every_row_is_scored(spark, awkward_docs, clashing):
    labels = spark.createDataFrame([(k, k % 2, k % 3 // 2) for k in range(25)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    for df in (awkward_docs, clashing(awkward_docs)):
        rows = T.toxicity(df, labels).collect()
        assert len(rows) == awkward_docs.count()
        for r in rows:
            assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
            assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    assert rows_of(T.toxicity(awkward_docs.limit(0), labels)) == []
    assert {r.predicted for r in T.toxicity(awkward_docs, labels.limit(0)).collect()} == {0}


def test_learns_nothing_from_held_out_labels(spark):
    texts, marks = sample(random.Random(4), 300, ["grubwit"])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    right = [(k, int(m)) for k, m in enumerate(marks)]
    wrong = [(k, 1 - m if zlib.crc32(str(k).encode()) % 3 == 1 else m) for k, m in right]
    a, b = (rows_of(T.toxicity(docs, spark.createDataFrame(x, "doc_id long, toxic int"))) for x in (right, wrong))
    assert a == b


def test_a_toxic_passage_counts_whatever_stands_around_it(model):
    rng = random.Random(6)
    around = [prose(rng, n) for n in (0, 300, 5_000, 6_321)]
    passage = " ".join(["scumbag worthless grubwit", prose(rng, 60)] * 10)
    for before in around:
        for behind in around:
            assert (logits(model, [f"{before} {passage} {behind}"]) > np.log(0.7 / 0.3)).all()
    assert (logits(model, around) < 0).all()


def test_windows_by_brute_force(model):
    import pyarrow as pa

    rng = random.Random(8)
    texts = [prose(rng, n) for n in (0, 1, 7, 999, 1_000, 1_001, 2_000, 3_456)] + ["", prose(rng, 2_500)]
    for chunk in T.W.chunks(pa.array(texts)):
        bag = T.bags(chunk)
        words_ = T.word_logits(model, bag)[bag.which]
        expected = []
        for k in range(len(chunk.bounds) - 1):
            own = words_[bag.of[k] : bag.of[k + 1]].tolist()
            n = len(own)
            if not n:
                expected.append(model.bias)
                continue
            windows = -(-n // T.WINDOW)
            cut = lambda half: -(-half * n // (2 * windows))  # noqa: B023, E731
            spans = [(cut(h), cut(h + 2)) for h in range(2 * windows - 1)]
            tops = [sorted(own[a:b], reverse=True) for a, b in spans]
            expected.append(max(t[int(np.ceil(len(t) * T.SHARE)) - 1] for t in tops))
        assert T.text_logits(model, bag).tolist() == pytest.approx(expected, rel=1e-6)


def test_sample_takes_one_text_of_each_id(spark):
    docs = spark.createDataFrame([(k % 3, f"text {k}") for k in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1)], "doc_id long, toxic int")
    known = [k for k in range(3) if zlib.crc32(str(k).encode()) % 3 != 1]
    texts, marks = T.labelled_sample(docs, labels, "doc_id", "text", "toxic")
    assert len(texts) == len(marks) == len(known)
    assert sorted(int(t.split()[1]) % 3 for t in texts) == known
    assert T.labelled_sample(docs.repartition(7), labels, "doc_id", "text", "toxic")[0] == texts
