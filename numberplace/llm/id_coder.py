"""Lossless coding of token ids: an adaptive range coder that mixes order-0 to order-2 predictions.

A block of ids is coded on its own, with models that start empty. The last id
seen behind the two ids before (order 2) and behind the one before (order 1) are
predictions, each with its recent hits as confidence. First it is coded whether
the order-2 prediction holds, or else the order-1 prediction, or neither; the
two confidences choose adaptive counts, and these are mixed by a weight that
moves to the order that was right more often. An id that neither predicts is
coded by its order-0 count. Counts, weights and the order-0 model take in what
was coded at the ends of growing segments.

Many blocks are coded side by side, a step of all of them at a time on NumPy
arrays. All arithmetic of the models is on integers.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np

#: Ids in a block; coded blocks do not depend on each other.
BLOCK = 2_048
#: Blocks that are coded side by side; some 0.2 MB each, and the more the faster.
SIDE_BY_SIDE = 768

_WEIGHT = 32  # of an id seen once, against 1 for one never seen
_SLOTS = 1 << 11
_GROWN = np.array([1, 2, 3, 4, 4])  # confidence after a hit
_TOP, _LEAST = 1 << 48, 1 << 32
_STEPS = 1 << 40  # keeps the order-0 tables of blocks apart


def segments(size: int) -> list[tuple[int, int]]:
    """Where the models take in what was coded before."""
    cuts = [c for c in (0, 128, 256, 512, 1024) if c < size] + [size]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def _first_slot(last: np.ndarray) -> np.ndarray:
    return last * 0x9E3779B1 >> 15 & (_SLOTS - 1)


def _second_slot(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    return (before * 0x9E3B + last) * 0x9E3779B1 >> 17 & (_SLOTS - 1)


class _Mixer:
    """Adaptive counts of three outcomes by the confidence of either order, for blocks side by side."""

    def __init__(self, blocks: int) -> None:
        self.second = np.zeros((blocks, 10, 3), np.int64)
        self.first = np.zeros((blocks, 10, 3), np.int64)
        self.right = np.ones((blocks, 2), np.int64)
        self.refresh()

    def refresh(self) -> None:
        share = [(x * 4096 + 1365) // (x.sum(2, keepdims=True) + 1) for x in (self.second, self.first)]
        self.shares = share
        weight = np.clip(16 * self.right[:, 0] // self.right.sum(1), 2, 14)[:, None, None, None, None]
        second = share[0].reshape(-1, 5, 1, 2, 3)
        first = share[1].reshape(-1, 1, 5, 2, 3)
        mixed = 1 + ((weight * second + (16 - weight) * first) >> 4)
        # By block, order-2 and order-1 confidence, agreement: where each outcome begins, and the total.
        self.mixed = np.concatenate([np.zeros_like(mixed[..., :1]), np.cumsum(mixed, axis=-1)], axis=-1).reshape(-1, 4)

    def absorb(self, block: np.ndarray, second: np.ndarray, first: np.ndarray, agree: np.ndarray, outcome: np.ndarray) -> None:
        keys = [(block * 10 + own * 2 + agree) * 3 + outcome for own in (second, first)]
        for counts, key in zip((self.second, self.first), keys, strict=True):
            counts += np.bincount(key, minlength=counts.size).reshape(counts.shape)
        a, b = (share.reshape(-1)[key] for share, key in zip(self.shares, keys, strict=True))
        n = len(self.right)
        self.right[:, 0] += np.bincount(block[a > b], minlength=n)
        self.right[:, 1] += np.bincount(block[b > a], minlength=n)
        self.refresh()


def _predictions(ids: np.ndarray, block: np.ndarray, place: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every id of a slot, in order: the id that was last there (or -1), and the confidence from 0 (none) to 4."""
    key = (block.astype(np.uint64) << np.uint64(40)) | (slot.astype(np.uint64) << np.uint64(24)) | place.astype(np.uint64)
    order = np.argsort(key)
    key, own = key[order] >> np.uint64(24), ids[order]
    same = np.zeros(len(key), bool)
    same[1:] = key[1:] == key[:-1]
    last = np.full(len(key), -1, np.int64)
    last[1:][same[1:]] = own[:-1][same[1:]]
    at = np.arange(len(key))
    missed = np.maximum.accumulate(np.where(last == own, -1, at))
    runs = np.zeros(len(key), np.int64)
    runs[1:] = np.minimum(at[:-1] - missed[:-1], 3) + 1
    runs[~same] = 0
    guess, sure = np.empty_like(last), np.empty_like(runs)
    guess[order], sure[order] = last, runs
    return guess, sure


def _encode(rows: Sequence[np.ndarray], alphabet: int) -> list[bytes]:
    """Code blocks of falling length."""
    sizes = np.array([len(r) for r in rows])
    block, ids = np.repeat(np.arange(len(rows)), sizes), np.concatenate(rows).astype(np.int64)
    begins = np.cumsum(sizes) - sizes
    place = np.arange(len(ids)) - begins[block]
    guess, sure = np.full((2, len(ids)), -1, np.int64), np.zeros((2, len(ids)), np.int64)
    for order in (1, 2):
        known = np.flatnonzero(place >= order)
        if len(known):
            slot = _first_slot(ids[known - 1]) if order == 1 else _second_slot(ids[known - 2], ids[known - 1])
            guess[order - 1, known], sure[order - 1, known] = _predictions(ids[known], block[known], place[known], slot)
    first, second = sure
    agree = ((first > 0) & (second > 0) & (guess[0] == guess[1])).astype(np.int64)
    outcome = np.where((second > 0) & (guess[1] == ids), 0, np.where((first > 0) & (guess[0] == ids), 1, 2))
    mixer = _Mixer(len(rows))
    mixed = np.empty((len(ids), 4), np.int32)
    low0, freq0, total0 = (np.zeros(len(ids), np.int32) for _ in range(3))
    for start, stop in segments(int(sizes.max())):
        own = np.flatnonzero((place >= start) & (place < stop))
        mixed[own] = mixer.mixed[block[own] * 50 + second[own] * 10 + first[own] * 2 + agree[own]]
        plain = own[outcome[own] == 2]
        seen = _sorted_history(rows, start) if start else np.empty(0, np.int64)
        key = block[plain] * _STEPS + ids[plain]
        by_key = np.argsort(key)  # neighbours look up the same places
        below, count = np.empty((2, len(key)), np.int64)
        below[by_key] = np.searchsorted(seen, key[by_key])
        count[by_key] = np.searchsorted(seen, key[by_key], "right")
        count -= below
        low0[plain] = _WEIGHT * (below - block[plain] * start) + ids[plain]
        freq0[plain] = _WEIGHT * count + 1
        total0[plain] = _WEIGHT * start + alphabet
        mixer.absorb(block[own], second[own], first[own], agree[own], outcome[own])
    # One operation per id, and a second one where nothing predicted it. They lie
    # step by step, the blocks with most of them first.
    plain = outcome == 2
    step = np.cumsum(plain) - plain + np.arange(len(ids))
    step -= step[begins][block]
    n_ops = np.add.reduceat(plain + 1, begins)
    order = np.argsort(-n_ops, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    live = np.searchsorted(-n_ops[order], -np.arange(1, int(n_ops.max()) + 1), "right")
    offsets = np.cumsum(live) - live
    ops = np.empty((3, int(n_ops.sum())), np.int32)
    at, everywhere = offsets[step] + rank[block], np.arange(len(ids))
    cum = mixed[everywhere, outcome]
    ops[0, at], ops[1, at], ops[2, at] = cum, mixed[everywhere, outcome + 1] - cum, mixed[:, 3]
    at = offsets[step[plain] + 1] + rank[block[plain]]
    ops[0, at], ops[1, at], ops[2, at] = low0[plain], freq0[plain], total0[plain]
    return _range_code(ops, live, n_ops[order], order)


def _sorted_history(rows: Sequence[np.ndarray], size: int) -> np.ndarray:
    """The first ``size`` ids of every block that has more, sorted within the block, blocks apart by ``_STEPS``."""
    more = [r for r in rows if len(r) > size]  # rows fall in length
    past = np.sort(np.stack([r[:size] for r in more]), axis=1).astype(np.int64)
    return (past + np.arange(len(more))[:, None] * _STEPS).reshape(-1)


def _range_code(ops: np.ndarray, live: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> list[bytes]:
    """Code (begin, width, total) of every operation, ``live[k]`` blocks having a k-th one."""
    low, span = np.zeros(len(sizes), np.int64), np.full(len(sizes), _TOP, np.int64)
    words, at = np.zeros((len(sizes), int(sizes.max()) + 8), np.int32), np.zeros(len(sizes), np.int64)
    begin = 0
    for n in live.tolist():
        cum, freq, total = ops[:, begin : begin + n]
        begin += n
        part = (span[:n] / total).astype(np.int64)
        low[:n] += part * cum
        np.multiply(part, freq, out=span[:n])
        out = np.flatnonzero(span[:n] < _LEAST)
        while len(out):
            words[out, at[out]] = low[out] >> 32
            at[out] += 1
            low[out] = (low[out] & 0xFFFFFFFF) << 16
            span[out] <<= 16
            out = out[span[out] < _LEAST]
    coded: list[bytes] = [b""] * len(sizes)
    for k, block in enumerate(order.tolist()):
        own = np.concatenate([words[k, : at[k]], [low[k] >> 32, low[k] >> 16 & 0xFFFF, low[k] & 0xFFFF]])
        carried = int.from_bytes((own >> 16).astype(">u2").tobytes(), "big") << 16
        value = int.from_bytes((own & 0xFFFF).astype(">u2").tobytes(), "big") + carried
        coded[block] = value.to_bytes(2 * len(own), "big").rstrip(b"\0")
    return coded


def _decode(coded: Sequence[bytes], sizes: np.ndarray, alphabet: int) -> np.ndarray:
    """Blocks of falling size, as rows of one array."""
    n_blocks, longest = len(coded), int(sizes.max())
    width = max(map(len, coded)) // 2 + 64
    words = np.zeros((n_blocks, width), ">u2")
    for k, data in enumerate(coded):
        words[k, : (len(data) + 1) // 2] = np.frombuffer(data + b"\0" * (len(data) % 2), ">u2")
    words = words.astype(np.int64).reshape(-1)
    at = np.arange(n_blocks) * width + 3
    off = words[at - 3] << 32 | words[at - 2] << 16 | words[at - 1]
    span = np.full(n_blocks, _TOP, np.int64)
    ids = np.zeros((longest, n_blocks), np.int64)
    # An entry is the id times 8 plus the confidence, 0 for none.
    kind = np.int32 if alphabet <= 1 << 28 else np.int64
    firsts, seconds = np.zeros(n_blocks * _SLOTS, kind), np.zeros(n_blocks * _SLOTS, kind)
    everyone, nothing, mixer = np.arange(n_blocks), np.zeros(n_blocks, np.int64), _Mixer(n_blocks)
    tables = everyone * _SLOTS

    def settle(who: np.ndarray) -> None:
        while len(who):
            off[who] = off[who] << 16 | words[at[who]]
            at[who] += 1
            span[who] <<= 16
            who = who[span[who] < _LEAST]

    for start, stop in segments(longest):
        n = int(np.searchsorted(-sizes, -start, "left"))
        values = np.sort(np.ascontiguousarray(ids[:start, :n].T), axis=1)
        past = (values + _WEIGHT * np.arange(start) + everyone[:n, None] * _STEPS).reshape(-1)
        run_first, run_size = _runs(values)
        values = values.reshape(-1)
        total0 = _WEIGHT * start + alphabet
        log: list[tuple[np.ndarray, ...]] = []
        for place in range(start, stop):
            n = int(np.searchsorted(-sizes, -place, "left"))
            live = everyone[:n]
            entry1 = entry2 = nothing[:n]
            if place:
                slot1 = tables[:n] + _first_slot(ids[place - 1, :n])
                entry1 = firsts[slot1].astype(np.int64)
            if place > 1:
                slot2 = tables[:n] + _second_slot(ids[place - 2, :n], ids[place - 1, :n])
                entry2 = seconds[slot2].astype(np.int64)
            guess1, sure1, guess2, sure2 = entry1 >> 3, entry1 & 7, entry2 >> 3, entry2 & 7
            agree = ((guess1 == guess2) & (sure1 > 0) & (sure2 > 0)).astype(np.int64)
            mixed = mixer.mixed[live * 50 + sure2 * 10 + sure1 * 2 + agree]
            part = (span[:n] / mixed[:, 3]).astype(np.int64)
            point = (off[:n] / part).astype(np.int64)
            outcome = (point >= mixed[:, 1]).astype(np.int64) + (point >= mixed[:, 2])
            cum = mixed[live, outcome]
            off[:n] -= part * cum
            span[:n] = part * (mixed[live, outcome + 1] - cum)
            settle(np.flatnonzero(span[:n] < _LEAST))
            found = np.where(outcome == 0, guess2, guess1)
            plain = np.flatnonzero(outcome == 2)
            if len(plain):
                span0, off0 = span[plain], off[plain]
                part = (span0 / total0).astype(np.int64)
                point = np.minimum((off0 / part).astype(np.int64), total0 - 1)
                # Seen ids stand _WEIGHT apart and their number up; the ones between were never seen.
                if start:
                    base = plain * _STEPS
                    j = np.searchsorted(past, base + point, "right") - 1
                    any_ = j >= plain * start
                    j = np.maximum(j, 0)
                    over = point - (past[j] - base)
                    seen = any_ & (over <= _WEIGHT)
                    below = np.where(any_, np.where(seen, run_first[j], j - plain * start + 1), 0)
                    freq = np.where(seen, 1 + _WEIGHT * run_size[j], 1)
                    value = np.where(seen, values[j], point - _WEIGHT * below)
                else:
                    below, freq, value = 0, 1, point
                found[plain] = value
                span[plain] = span0 = part * freq
                off[plain] = off0 - part * (_WEIGHT * below + value)
                settle(plain[span0 < _LEAST])
            ids[place, :n] = found
            if place:
                firsts[slot1] = found * 8 + np.where(guess1 == found, _GROWN[sure1], 1)
            if place > 1:
                seconds[slot2] = found * 8 + np.where(guess2 == found, _GROWN[sure2], 1)
            log.append((live, sure2, sure1, agree, outcome))
        mixer.absorb(*(np.concatenate(x) for x in zip(*log, strict=True)))
    return ids.T


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted rows, flat: the column where each value's run begins, and the run's length."""
    n, size = values.shape
    if not size:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    fresh = np.ones((n, size), bool)
    fresh[:, 1:] = values[:, 1:] != values[:, :-1]
    heads = np.flatnonzero(fresh.reshape(-1))
    lengths = np.diff(heads, append=n * size)
    return np.repeat(heads % size, lengths), np.repeat(lengths, lengths)


def checksum(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def encode_blocks(blocks: Sequence[np.ndarray], alphabet: int) -> list[bytes]:
    """Code blocks of 1 to ``BLOCK`` ids below ``alphabet``, each on its own."""
    order = sorted(range(len(blocks)), key=lambda k: -len(blocks[k]))
    coded: list[bytes] = [b""] * len(blocks)
    for start in range(0, len(order), SIDE_BY_SIDE):
        group = order[start : start + SIDE_BY_SIDE]
        for k, data in zip(group, _encode([blocks[k] for k in group], alphabet), strict=True):
            coded[k] = data
    return coded


def decode_blocks(coded: Sequence[bytes], sizes: Sequence[int], checksums: Sequence[int], alphabet: int) -> list[np.ndarray]:
    """Blocks back from their codes; a ``ValueError`` if one does not have its checksum."""
    order = sorted(range(len(coded)), key=lambda k: -sizes[k])
    blocks: list[np.ndarray] = [np.empty(0, np.int64)] * len(coded)
    for start in range(0, len(order), SIDE_BY_SIDE):
        group = order[start : start + SIDE_BY_SIDE]
        rows = _decode([coded[k] for k in group], np.array([sizes[k] for k in group]), alphabet)
        for k, row in zip(group, rows, strict=True):
            blocks[k] = row[: sizes[k]]
            if checksum(blocks[k]) != checksums[k]:
                raise ValueError(f"block {k} is damaged")
    return blocks
