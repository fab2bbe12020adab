"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The text is cut into units (a run of blanks with what follows it up to the next
blank): no piece of the model holds anything before a blank mark, so no merge
crosses a unit. The distinct units of a batch lie in flat symbol arrays. A round
finds the least pair rank of every unit, merges its leftmost occurrences all at
once, and compacts the arrays; units without a pair are done. Where a better
pair could arise from a merge, only the leftmost occurrence is merged, which is
what a queue of pairs does.

Null texts count as empty, an empty text has no ids. Every text is encoded whole;
a unit takes some 40 bytes of memory per character.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from numberplace.llm.shared import shared

BLANK = "▁"
#: Distinct units whose ids a task remembers, and texts it takes at a time, in characters.
MEMORY_UNITS = 250_000
BLOCK_CHARS = 400_000
#: Characters that go through the merge rounds together; their arrays fit a processor's cache.
ROUND_CHARS = 60_000

_UNITS = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
_NONE = np.iinfo(np.int32).max
_MERGED = -2


class Codec(NamedTuple):
    """Tables made from a model file.

    ``symbols`` numbers the pieces first (by id), then characters that only occur
    inside pieces. ``of_char`` gives a character's symbol or -1. ``keys`` (sorted)
    are left * len(symbols) + right of each pair that makes a piece ``made``, whose
    rank is ``rank`` (lower is merged first) and which is ``safe`` if no piece made
    from it has a lower rank.
    """

    symbols: list[str]
    pieces: int
    of_char: np.ndarray
    keys: np.ndarray
    made: np.ndarray
    rank: np.ndarray
    safe: np.ndarray
    id_bytes: list[bytes]
    piece_bytes: list[bytes]
    byte_ids: np.ndarray


def load_codec(model: str) -> Codec:
    """Read a BPE model with byte fallback, a blank mark before the text and no normalisation."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    size = processor.get_piece_size()
    names = [processor.id_to_piece(i) for i in range(size)]
    plain = [
        not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i) or processor.is_unused(i))
        for i in range(size)
    ]
    if any(BLANK in name.lstrip(BLANK) or name[:2] == BLANK * 2 and name.strip(BLANK)
           for name, is_plain in zip(names, plain, strict=True) if is_plain):
        raise ValueError("the model has pieces that go beyond a blank")
    if processor.encode("a  b ", out_type=str)[0][0] != BLANK or processor.decode(processor.encode(" a  ﬁ ")) != " a  ﬁ ":
        raise ValueError("the model normalises texts")
    number = {name: i for i, name in enumerate(names) if plain[i]}
    symbols = list(names)
    for char in sorted({c for name in number for c in name} - set(number)):
        number[char] = len(symbols)
        symbols.append(char)
    of_char = np.full(sys.maxunicode + 1, -1, np.int32)
    for name, i in number.items():
        if len(name) == 1:
            of_char[ord(name)] = i
    scores = np.array([processor.get_score(i) for i in range(size)])
    ranks = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
    keys, made, unsafe = [], [], set()
    for name, i in number.items():
        for cut in range(1, len(name)):
            left, right = number.get(name[:cut]), number.get(name[cut:])
            if left is None or right is None:
                continue
            keys.append(left * len(symbols) + right)
            made.append(i)
            unsafe.update(part for part in (left, right) if part < size and ranks[part] >= ranks[i])
    order = np.argsort(np.array(keys, np.int64))
    made = np.array(made, np.int32)[order]
    safe = np.ones(len(symbols), bool)
    safe[list(unsafe)] = False
    byte_ids = np.array([processor.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
    piece_bytes = [name.replace(BLANK, " ").encode() for name in names]
    for b, i in enumerate(byte_ids):
        piece_bytes[i] = bytes([b])
    return Codec(symbols, size, of_char, np.array(keys, np.int64)[order], made, ranks[made], safe,
                 [str(i).encode() for i in range(size)], piece_bytes, byte_ids)


def units(text: str) -> list[str]:
    """Cut a text after adding the blank mark before it."""
    if not text:
        return []
    text = text.replace(BLANK, " ")
    if "  " in text or text[0] == " " or text[-1] == " ":
        return _UNITS.findall(BLANK + text.replace(" ", BLANK))
    return [BLANK + part for part in text.split(" ")]


def _pairs(codec: Codec, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Index into the pair tables, or -1."""
    key = left.astype(np.int64) * len(codec.symbols) + right
    at = np.searchsorted(codec.keys, key)
    at[at == len(codec.keys)] = 0
    at[(codec.keys[at] != key) | (left < 0) | (right < 0)] = -1
    return at.astype(np.int32)


def merge_rounds(codec: Codec, chars: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all units in order, and the first character of each.

    ``chars`` are the code points of all units in a row, ``of`` the unit of each.
    """
    symbol = codec.of_char[chars]
    unit, first = of.astype(np.int32), np.arange(len(chars), dtype=np.int32)
    result = np.full(len(chars), _MERGED, np.int32)
    ranks = np.append(codec.rank, _NONE).astype(np.int32)  # index -1: no pair
    pair = np.full(len(symbol), -1, np.int32)
    inner = np.flatnonzero(unit[:-1] == unit[1:])
    pair[inner] = _pairs(codec, symbol[inner], symbol[inner + 1])
    while len(symbol):
        fresh = np.empty(len(unit), bool)
        fresh[0] = True
        np.not_equal(unit[1:], unit[:-1], out=fresh[1:])
        heads = np.flatnonzero(fresh)
        rank = ranks[pair]
        least = np.minimum.reduceat(rank, heads)
        lengths = np.diff(heads, append=len(symbol))
        open_ = least != _NONE
        if not open_.all():
            keep = np.repeat(open_, lengths)
            result[first[~keep]] = symbol[~keep]
            unit, first, symbol, pair, rank, fresh = (x[keep] for x in (unit, first, symbol, pair, rank, fresh))
            least, lengths = least[open_], lengths[open_]
            if not len(symbol):
                break
        hit = np.flatnonzero(rank == np.repeat(least, lengths))
        # Of touching occurrences every second one from the left merges.
        touching = np.diff(hit, prepend=-2) == 1
        if touching.any():
            place = np.arange(len(hit))
            run = place - np.maximum.accumulate(np.where(touching, 0, place))
            hit = hit[run % 2 == 0]
        made = codec.made[pair[hit]]
        again = np.diff(unit[hit], prepend=-1) == 0
        if again.any():
            # The leftmost one only, where a merge can open a better pair or ranks tie.
            risky = ~codec.safe[made] | (np.diff(made, prepend=made[0]) != 0)
            group = np.cumsum(~again) - 1
            bad = np.zeros(group[-1] + 1, bool)
            bad[group[risky]] = True
            keep = ~(again & bad[group])
            hit, made = hit[keep], made[keep]
        symbol[hit] = made
        # Only pairs at or just before a merge change.
        last = np.append(fresh[1:], True)
        stale = np.zeros(len(symbol), bool)
        stale[hit] = True
        stale[hit[hit > 0] - 1] = True
        keep = np.ones(len(symbol), bool)
        keep[hit + 1] = False
        last[hit] = last[hit + 1]
        # A symbol that goes hands its mark to the one before it.
        stale[hit[:-1][np.diff(hit) == 2]] = True
        unit, first, symbol, pair, stale, last = (x[keep] for x in (unit, first, symbol, pair, stale, last))
        pair[stale] = -1
        stale = np.flatnonzero(stale & ~last)
        pair[stale] = _pairs(codec, symbol[stale], symbol[stale + 1])
    first = np.flatnonzero(result != _MERGED)
    return first, result[first]


def encode_units(codec: Codec, texts: list[str]) -> list[np.ndarray]:
    """Ids of each unit; characters that no piece has become the ids of their bytes."""
    found, start, size = [], 0, 0
    for stop, text in enumerate(texts, 1):
        size += len(text)
        if size >= ROUND_CHARS or stop == len(texts):
            found += _encode_block(codec, texts[start:stop])
            start, size = stop, 0
    return found


def _encode_block(codec: Codec, texts: list[str]) -> list[np.ndarray]:
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    of = np.repeat(np.arange(len(texts)), lengths)
    first, symbol = merge_rounds(codec, chars, of)
    unit = of[first]
    strange = np.flatnonzero((symbol < 0) | (symbol >= codec.pieces))
    if len(strange):
        spelt = [codec.byte_ids[list(chr(c).encode())] for c in chars[first[strange]]]
        sizes = np.ones(len(symbol), np.int64)
        sizes[strange] = [len(x) for x in spelt]
        out = np.repeat(symbol, sizes)
        begins = np.cumsum(sizes) - sizes
        for k, ids in zip(begins[strange], spelt, strict=True):
            out[k : k + len(ids)] = ids
        unit, symbol = np.repeat(unit, sizes), out
    cuts = np.searchsorted(unit, np.arange(len(texts) + 1)).tolist()
    return [symbol[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


def encode(codec: Codec, texts: list[str]) -> list[np.ndarray]:
    """Ids of each text."""
    cut = [units(text) for text in texts]
    distinct = list(dict.fromkeys(u for parts in cut for u in parts))
    known = dict(zip(distinct, encode_units(codec, distinct), strict=True))
    none = np.empty(0, np.int32)
    return [np.concatenate([none, *(known[u] for u in parts)]) for parts in cut]


def decode(codec: Codec, ids: np.ndarray) -> str:
    """The text of ids: pieces joined, less the blank that encoding puts before a text."""
    joined = b"".join(codec.piece_bytes[i] for i in ids)
    return joined.removeprefix(b" ").decode("utf-8", "replace")


def _blocks(texts: list[str | None]) -> Iterator[list[str]]:
    block, size = [], 0
    for text in texts:
        block.append(text or "")
        size += len(block[-1])
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def piece_digests(
    df: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Per row: the id, ``n_tokens``, ``ids_sha256`` of its ids and ``decoded_sha256`` of their text.

    One pass without a shuffle. Ids and decoded bytes are worked out once per
    distinct unit and joined per text. Null texts are empty. ``keep`` names
    columns to carry along; other columns are dropped.
    """
    codec = shared(df.sparkSession, load_codec(model))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = codec()
        known: dict[str, tuple[bytes, bytes]] = {}
        for batch in batches:
            counts, encoded, decoded = [], [], []
            for block in _blocks(batch.column(text_column).to_pylist()):
                cut = [units(text) for text in block]
                new = list({u for parts in cut for u in parts}.difference(known))
                for u, ids in zip(new, encode_units(tables, new), strict=True):
                    own = ids.tolist()
                    known[u] = (b",".join([tables.id_bytes[i] for i in own]),
                                b"".join([tables.piece_bytes[i] for i in own]))
                for parts in cut:
                    found = [known[u] for u in parts]
                    ids = b",".join([x[0] for x in found])
                    text = b"".join([x[1] for x in found]).removeprefix(b" ")
                    counts.append(ids.count(b",") + 1 if parts else 0)
                    encoded.append(hashlib.sha256(ids).hexdigest())
                    decoded.append(hashlib.sha256(text).hexdigest())
                if len(known) > MEMORY_UNITS:
                    known.clear()
            columns = [batch.column(name) for name in (id_column, *keep)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())],
                [id_column, *keep, "n_tokens", "ids_sha256", "decoded_sha256"])

    types = dict(df.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in (id_column, *keep)),
                        "n_tokens long, ids_sha256 string, decoded_sha256 string"])
    return df.select(id_column, *keep, text_column).mapInArrow(digests, schema)
