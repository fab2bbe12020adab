import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from numberplace.llm import id_coder as I
from numberplace.llm import id_files as Files
from numberplace.llm.queries import tokenizer_path
from numberplace.session import scratch_path

from .conftest import rows_of

TOKENIZER, RANKS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def pattern():
    import public_tokenizers

    return public_tokenizers.PATTERN


def blocks():
    rng = np.random.default_rng(1)
    top = 50_257
    out = [[0], [0, 0], [top - 1] * 300, np.zeros(I.BLOCK), rng.integers(0, top, I.BLOCK), rng.integers(0, top, 777),
           np.arange(4_000) % 7, rng.zipf(1.3, 4_000) % top, np.r_[np.arange(300), np.arange(300), rng.integers(0, 20, 3_000)]]
    return [np.asarray(x, np.int64) for x in out + [rng.integers(0, 50, n) for n in range(1, 300, 7)]]


@pytest.mark.parametrize("together", [1, 5, 768])
def test_blocks_come_back_whatever_is_coded_beside_them(monkeypatch, together):
    own = blocks()
    whole = I.encode_blocks(own, 50_257)
    monkeypatch.setattr(I, "SIDE_BY_SIDE", together)
    coded = I.encode_blocks(own, 50_257)
    assert coded == whole
    back = I.decode_blocks(coded, [len(x) for x in own], [I.checksum(x) for x in own], 50_257)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(own, back, strict=True))


def test_repetition_is_coded_shorter_and_damage_is_seen():
    own = blocks()
    coded = I.encode_blocks(own, 50_257)
    assert len(coded[6]) < 100 and len(coded[4]) < 2.1 * I.BLOCK
    damaged = bytes([coded[4][0] ^ 1]) + coded[4][1:]
    with pytest.raises(ValueError):
        I.decode_blocks([damaged], [I.BLOCK], [I.checksum(own[4])], 50_257)


def test_same_ids_as_the_library(library):
    with open(TOKENIZER, "rb") as a, open(RANKS, "rb") as b:
        encode = Files.Encoder(a.read(), b.read(), pattern())
    texts = ["", "it's 'tis I'LL", " a  b\t\n c ", "<|endoftext|> x", "数 1²½Ⅷ", "\x85\xa0\x1c\u2028\u200b", "é" * 9]
    texts += [chr(c) + "a1 " + chr(c) for c in range(1, 0x260)]
    for text in texts:
        assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def expected(rows, library):
    out, start = [], 0
    for number, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((number, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def test_files(spark, awkward_docs, clashing, library, monkeypatch):
    rows = [(r.doc_id, r.text) for r in awkward_docs.collect()]
    for df in (awkward_docs, clashing(awkward_docs)):
        path = scratch_path(spark)
        Files.write_ids(df, path, TOKENIZER, RANKS, pattern())
        assert rows_of(Files.read_digests(spark, path)) == expected(rows, library)
    ids = {}
    for r in sorted(Files.read_ids(spark, path).collect(), key=lambda r: r.piece):
        ids.setdefault(r.doc_id, []).extend(r.ids)
    long = max((r for r in rows if r[0] is not None), key=lambda r: len(r[1] or ""))
    assert ids[long[0]] == [*library.encode(long[1], add_special_tokens=False).ids, 0]
    path = scratch_path(spark)
    Files.write_ids(awkward_docs.limit(0), path, TOKENIZER)
    assert rows_of(Files.read_digests(spark, path)) == []


def test_crc_of_pieces():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 5_000, np.uint8).tobytes()
    cuts = [0, 1, 400, 404, 3_000, 5_000]
    crcs = np.array([zlib.crc32(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], np.uint32)
    after = np.array([len(data) - b for b in cuts[1:]])
    assert np.bitwise_xor.reduce(Files.followed(crcs, after)) == zlib.crc32(data)
