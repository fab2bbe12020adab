"""Words, hashes and word n-grams of whole text columns, on flat NumPy arrays.

A word is ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 bytes. A word's hash is the sum of
a random number per byte times a power of an odd base, modulo 2**64, which a
running sum over all bytes gives for every word at once. Texts are taken in
chunks of some hundred kB, so the arrays stay small whatever the batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_GRAM = np.uint64(0xD1342543DE82EF95)

SOLID = np.ones(256, bool)
SOLID[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_CODES = np.random.RandomState(20240229).randint(0, 2**64, 256, np.uint64)
_LOWER_CODES = _CODES.copy()
_LOWER_CODES[65:91] = _CODES[97:123]
_powers: dict[str, np.ndarray] = {}


class Chunk(NamedTuple):
    """Texts ``first`` to ``first + len(bounds) - 2`` of a column, as one run of bytes."""

    first: int
    data: np.ndarray
    bounds: np.ndarray


class Words(NamedTuple):
    """Byte ranges and hashes of words; ``of[i]`` to ``of[i + 1]`` are the words of text i."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    of: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def order_of(keys: np.ndarray) -> np.ndarray:
    """A stable order of 64-bit hashes.

    Their upper bits are sorted together with the position, several times as fast as
    ``argsort``, which is the way out if two keys differ in the lower bits only.
    """
    low = np.uint64((1 << len(keys).bit_length()) - 1)
    order = (np.sort((keys & ~low) | np.arange(len(keys), dtype=np.uint64)) & low).astype(np.int64)
    ordered = keys[order]
    return np.argsort(keys, kind="stable") if (ordered[1:] < ordered[:-1]).any() else order


def distinct(keys: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of keys put in ``order``: where each distinct one begins, and how often it occurs."""
    ordered = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    heads = np.flatnonzero(fresh)
    return heads, np.diff(heads, append=len(keys))


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """A text column as runs of bytes; a null counts as an empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        bounds = offsets[first : last + 1]
        yield Chunk(first, data[bounds[0] : bounds[-1]], bounds - bounds[0])
        first = last


def _power(kind: str, base: int, size: int) -> np.ndarray:
    known = _powers.get(kind)
    if known is None or len(known) < size:
        steps = np.full(max(size, 2 * CHUNK_BYTES), np.uint64(base & (2**64 - 1)))
        steps[0] = 1
        known = _powers[kind] = np.multiply.accumulate(steps)
    return known[:size]


def pieces(chunk: Chunk, solid: np.ndarray = SOLID) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``solid`` bytes within each text, and where each text's runs begin."""
    data, bounds = chunk.data, chunk.bounds
    if not len(data):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(bounds), np.int64)
    inside = solid[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    heads = bounds[:-1][bounds[:-1] < len(data)]
    begin[heads] = inside[heads]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    tails = bounds[1:][bounds[1:] > 0] - 1
    end[tails] = inside[tails]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each byte range; with ``lower``, A-Z counts as a-z."""
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    values = (_LOWER_CODES if lower else _CODES)[data]
    values *= _power("up", int(_BASE), len(data))
    np.cumsum(values, out=sums[1:])
    inverse = _power("down", pow(int(_BASE), -1, 2**64), len(data) + 1)
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def words(chunk: Chunk, lower: bool = False) -> Words:
    starts, ends, of = pieces(chunk)
    return Words(starts, ends, range_hashes(chunk.data, starts, ends, lower), of)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` words in a row; position i stands for words i to i + size - 1."""
    if len(hashes) < size:
        return np.empty(0, np.uint64)
    n = len(hashes) - size + 1
    total = hashes[:n].copy()
    for k in range(1, size):
        total *= _GRAM
        total += hashes[k : k + n]
    return mix(total)


def sequence_hash(hashes: np.ndarray) -> np.uint64:
    """A hash of a whole word sequence, unlike that of any sequence of another length."""
    scaled = hashes * _power("gram", int(_GRAM), max(1, len(hashes)))[: len(hashes)]
    return mix(np.array([scaled.sum(dtype=np.uint64) + np.uint64(len(hashes))], np.uint64))[0]
