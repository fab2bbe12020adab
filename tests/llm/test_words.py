import random

import numpy as np
import pyarrow as pa

from numberplace.llm import words as W

from .conftest import words


def test_words_hashes_and_chunks():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab é\t\n\x0b\x1f 数Z") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += [None, "", " ", "word"]
    seen = {}
    for size in (1, 64, 1 << 20):
        found = []
        for chunk in W.chunks(pa.array(texts), size):
            own = W.words(chunk)
            for k in range(len(chunk.bounds) - 1):
                at = range(own.of[k], own.of[k + 1])
                found.append([bytes(chunk.data[own.starts[i] : own.ends[i]]).decode() for i in at])
                for i in at:
                    assert seen.setdefault(found[-1][i - own.of[k]], own.hashes[i]) == own.hashes[i]
        assert found == [words(t) for t in texts]
    assert len(set(seen.values())) == len(seen)


def test_lower_case_and_grams():
    low, up = (W.words(next(W.chunks(pa.array([t]))), lower=True).hashes for t in ("ab cd É", "AB Cd É"))
    assert (low == up).all()
    grams = W.grams(np.tile(low, 3), 3)
    assert grams[0] == grams[3] != grams[1] and len(W.grams(low, 4)) == 0
    assert W.sequence_hash(low) != W.sequence_hash(low[:2])


def test_order_of_hashes_is_stable_whatever_they_share():
    rng = np.random.default_rng(5)
    for size in (0, 1, 2, 3, 1_000):
        spread = rng.integers(0, 2**64, max(1, size // 3), np.uint64)
        for keys in (rng.choice(spread, size), rng.integers(0, 50, size, np.uint64), np.arange(size, 0, -1).astype(np.uint64),
                     np.full(size, 2**64 - 1, np.uint64)):
            order = W.order_of(keys)
            assert order.tolist() == np.argsort(keys, kind="stable").tolist()
            heads, counts = W.distinct(keys, order)
            expected = np.unique(keys, return_counts=True)
            assert keys[order[heads]].tolist() == expected[0].tolist() and counts.tolist() == expected[1].tolist()
