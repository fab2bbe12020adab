import hashlib
import random

import pytest
import sentencepiece

from numberplace.llm import pieces_codec as C
from numberplace.llm.queries import tokenizer_path

from .conftest import rows_of

MODEL = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def codec():
    return C.load_codec(MODEL)


def awkward_texts():
    rng = random.Random(1)
    texts = ["", " ", "a", "  a  b ", "▁x▁", "a" * 3_000, " " * 500, "数é\n\t\r\x0b", "\x00\x01", "😀 ﬁ①", "<s> <0x41> <unk>"]
    texts += ["".join(rng.choice("ab c▁dé数😀 \n.-=tionher") for _ in range(rng.randint(0, 60))) for _ in range(800)]
    return texts + ["".join(rng.choice("aeinot") for _ in range(rng.randint(0, 300))) for _ in range(200)]


def test_same_ids_and_texts_as_the_library(codec, library):
    texts = awkward_texts()
    ids = C.encode(codec, texts)
    assert [x.tolist() for x in ids] == library.encode(texts)
    assert [C.decode(codec, x) for x in ids] == [library.decode(x.tolist()) for x in ids]


def test_only_the_leftmost_merges_where_a_better_pair_may_arise(codec, library):
    unsafe = [codec.symbols[i] for i in range(codec.pieces) if not codec.safe[i]][:400]
    texts = [a + b for a in unsafe[::7] for b in unsafe[::11]] + [x * 4 for x in unsafe]
    assert [x.tolist() for x in C.encode(codec, texts)] == library.encode(texts)


def test_digests(awkward_docs, clashing, library):
    expected = []
    for r in awkward_docs.collect():
        ids = library.encode(r.text or "")
        expected.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    expected.sort(key=repr)
    assert rows_of(C.piece_digests(awkward_docs, MODEL)) == expected
    assert rows_of(C.piece_digests(clashing(awkward_docs), MODEL)) == expected
    assert rows_of(C.piece_digests(awkward_docs.limit(0), MODEL)) == []


def test_blocks_and_memory_limits_change_nothing(awkward_docs, monkeypatch):
    whole = rows_of(C.piece_digests(awkward_docs, MODEL))
    for name, value in (("BLOCK_CHARS", 50), ("MEMORY_UNITS", 3), ("ROUND_CHARS", 7)):
        monkeypatch.setattr(C, name, value)
    assert rows_of(C.piece_digests(awkward_docs, MODEL)) == whole


def test_a_block_of_texts_leaves_room_for_two_workers():
    """Two workers an executor, with blocks of 4,000,000 characters, took more than its memory."""
    sizes = [len("".join(b)) for b in C._blocks(["word " * 400] * 1_000)]
    assert max(sizes) < 500_000 and sum(sizes) == 2_000_000
