"""Conversations with faults, repaired by the cheapest edits, found by branch-and-bound.

A repaired conversation is empty or has, after an optional system turn, pairs of a
user and an assistant turn. Rows are read in turn order (nulls first; rows of one
turn by role, then text). Blank and repeated rows have to go; every other row is kept
(0), given another role (2) or deleted (3), and empty turns are put in (2); a
truncated row that stays adds 1.

``cheapest`` searches depth first with a stack of its own. A node is a row position
and the role last written. Suffix bounds give the least that any way on from a node
costs; a prefix is cut off if its cost and bound, or with equal cost its audit, come
behind the incumbent's, and where it is no better than the best prefix that has
reached its node before (of two prefixes of equal cost at one node neither begins
the other, as only insertions could lengthen it and they cost, so the smaller one
stays smaller whatever follows).

Rows are sorted by a range partitioning over fixed-width keys that copies of one row
do not share, so a conversation of any size spreads over many tasks. Conversations
that lie inside one task are repaired there. Longer ones, and those at the edges of a
task, go on as segments of ``SEGMENT_ROWS`` rows: a segment is searched once from
each state into each, the segments' answers are put together in order, and the rows
are edited segment by segment.

Null roles and texts count as one space. A null conversation id is a conversation of
its own, a role without a character is never legal, other columns play no part.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from numberplace.session import stored

#: Rows of a conversation that are searched at once.
SEGMENT_ROWS = 512
#: Rows that go to a task's output together.
_BATCH = 2_000

KEEP, RETAG, DELETE, INSERT = "K", "R", "D", "I"
_COSTS = {KEEP: 0, RETAG: 2, DELETE: 3, INSERT: 2}
_TRUNCATED = 1
_SPACE = " \t\n\v\f\r"
_ENDS = ".!?"

# States: nothing written, or the initial of the turn last written.
START, SYSTEM, USER, ASSISTANT = range(4)
_STATES = (START, SYSTEM, USER, ASSISTANT)
#: The state after each initial; what may follow a state besides a kept system turn.
_STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
_FREE = {START: ("u", USER), SYSTEM: ("u", USER), ASSISTANT: ("u", USER), USER: ("a", ASSISTANT)}
_ROLES = {"u": "user", "a": "assistant"}
_FINAL = (START, ASSISTANT)
_FAR = 1 << 60

#: Code of a row that has to be deleted; others are their role's initial, upper case if truncated.
_GONE = "x"


def _edits(code: str | None, state: int) -> Iterator[tuple[str, int, int, int]]:
    """(letter, cost, rows taken, state after) of every edit at a node; no code behind the last row."""
    if code is not None:
        yield DELETE, _COSTS[DELETE], 1, state
    _, after = _FREE[state]
    yield INSERT, _COSTS[INSERT], 0, after
    if code is not None and code != _GONE:
        extra = _TRUNCATED if code.isupper() else 0
        kept = _STEP.get((state, code.lower()))
        if kept is not None:
            yield KEEP, _COSTS[KEEP] + extra, 1, kept
        yield RETAG, _COSTS[RETAG] + extra, 1, after


def _bounds(codes: str, exits: tuple[int, ...]) -> list[list[int]]:
    """The least cost from every node on into one of ``exits``."""
    here = [0 if state in exits else _FAR for state in _STATES]
    out: list[list[int]] = []
    for code in [None, *reversed(codes)]:
        if code is not None:
            here = [min(cost + out[-1][after] for _, cost, taken, after in _edits(code, state) if taken) for state in _STATES]
        for _ in _STATES:  # insertions, the only edits that stay at a position
            here = [min(here[state], _COSTS[INSERT] + here[_FREE[state][1]]) for state in _STATES]
        out.append(here)
    return out[::-1]


@functools.lru_cache(maxsize=100_000)
def cheapest(codes: str, entry: int = START, exits: tuple[int, ...] = _FINAL) -> tuple[int, str] | None:
    """The least (cost, audit) that leads over all rows from ``entry`` into one of ``exits``; None if nothing does."""
    bounds = _bounds(codes, exits)
    if bounds[0][entry] >= _FAR:
        return None
    best: tuple[int, str] = (_FAR, "")
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        least = cost + bounds[at][state]
        if least > best[0] or least == best[0] and audit > best[1][: len(audit)]:
            continue
        known = reached.get((at, state))
        if known is not None and known <= (cost, audit):
            continue
        reached[at, state] = cost, audit
        if at == len(codes) and state in exits:
            best = min(best, (cost, audit))
        code = codes[at] if at < len(codes) else None
        ways = [(cost + paid + bounds[at + taken][after], letter, paid, taken, after)
                for letter, paid, taken, after in _edits(code, state)]
        # The most promising way comes off the stack first.
        for total, letter, paid, taken, after in sorted(ways, reverse=True):
            if total <= best[0] and total < _FAR:
                stack.append((at + taken, after, cost + paid, audit + letter))
    return best


class Row(NamedTuple):
    turn: int | None
    role: str
    text: str


def fault(role: str, text: str, repeated: bool) -> str:
    """The code of a row: ``x`` with ``blank`` or ``duplicate`` told apart by ``text``; else its initial."""
    spoken = text.rstrip(_SPACE)
    if not spoken or repeated:
        return _GONE
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return initial if spoken[-1] in _ENDS else initial.upper()


class Faults(NamedTuple):
    """Faults of rows in a row, so that those of neighbouring runs can be added up."""

    codes: str
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    low: int | None
    high: int | None
    turns: int
    first: str
    last: str


def faults(rows: list[Row], repeated: list[bool]) -> Faults:
    codes = "".join(fault(r.role, r.text, again) for r, again in zip(rows, repeated, strict=True))
    blank = sum(not r.text.strip(_SPACE) for r in rows)
    initials = [r.role[:1] for r in rows]
    turns = [r.turn for r in rows if r.turn is not None]
    return Faults(
        codes, blank, codes.count(_GONE) - blank, sum(c.isupper() for c in codes),
        sum(_illegal(a, b) for a, b in zip(initials, initials[1:])),
        turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)), initials[0], initials[-1])


def _illegal(first: str, second: str) -> bool:
    return first + second not in ("su", "ua", "au")


def joined(one: Faults | None, two: Faults) -> Faults:
    """The faults of two runs of rows, the second right behind the first."""
    if one is None:
        return two
    shared = one.high is not None and one.high == two.low
    return Faults(
        one.codes + two.codes, one.blank + two.blank, one.duplicate + two.duplicate, one.truncated + two.truncated,
        one.illegal + two.illegal + _illegal(one.last, two.first), two.low if one.low is None else one.low,
        one.high if two.high is None else two.high, one.turns + two.turns - shared, one.first, two.last)


def _gaps(found: Faults) -> int:
    return 0 if found.low is None else found.high - found.low + 1 - found.turns


def repaired(rows: list[Row], audit: str, state: int = START) -> tuple[list[tuple[str, str]], int]:
    """(role, text) of the rows after the edits, and the state they end in."""
    out, left = [], iter(rows)
    for letter in audit:
        if letter == INSERT:
            name, state = _FREE[state]
            out.append((_ROLES[name], ""))
            continue
        row = next(left)
        if letter == KEEP:
            state = _STEP[state, row.role[:1]]
            out.append((row.role, row.text))
        elif letter == RETAG:
            name, state = _FREE[state]
            out.append((_ROLES[name], row.text))
    return out, state


# -- over tables ---------------------------------------------------------------

_STATS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_TURN = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
_STATS_DDL = ", ".join(f"{name} long" for name in _STATS)


def _key(column: str) -> Column:
    return F.xxhash64(column)


def _ordered(df: DataFrame, conv: str, turn: str, role: str, text: str, present: Column) -> DataFrame:
    """(key, conv_id, turn, role, text, present) sorted by conversation and row, in range partitions.

    Range keys have a fixed width, and the row number at their end splits copies.
    """
    rows = df.select(
        F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        present.alias("present"))
    rows = rows.withColumn("key", _key("conv_id")).withColumn("row", F.monotonically_increasing_id())
    place = [F.col("key"), F.col("turn").asc_nulls_first(), F.substring("role", 1, 16), F.substring("text", 1, 64)]
    ranged = rows.repartitionByRange(*place, F.col("row"))
    return ranged.sortWithinPartitions(
        "key", "conv_id", F.col("turn").asc_nulls_first(), F.substring("role", 1, 16), F.substring("text", 1, 64),
        "role", "text", "row").drop("row")


def _segments(ordered: DataFrame) -> DataFrame:
    """One row per conversation that lies inside a task, repaired; rows in segments of the others.

    (key, conv_id, part, segment, whole, stats, audit, turns): ``turns`` are the
    repaired ones of a ``whole`` conversation, else the rows as they are.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, kind = TaskContext.get().partitionId(), [], None

        def rows() -> Iterator[tuple]:
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field("conv_id").type
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        def conversations() -> Iterator[tuple[tuple, int, list[Row], bool]]:
            """Segments, each with whether its conversation ends with it before the task does."""
            number = 0
            for (conv, key), group in groupby(rows(), key=lambda r: (r[0], r[5])):
                held = []
                for _, turn, role, text, present, _ in group:
                    if len(held) == SEGMENT_ROWS:
                        yield (conv, key), number, held, False
                        number, held = number + 1, []
                    if present:
                        held.append(Row(turn, role, text))
                yield (conv, key), number, held, True
                number += 1

        waiting, previous = None, None
        for item in conversations():
            if waiting is not None:
                out.append(_whole_or_not(waiting, part, previous, item[0]))
                previous = waiting[0]
            waiting = item
            if len(out) >= _BATCH:
                yield _batch(out, kind)
                out = []
        if waiting is not None:
            out.append(_whole_or_not(waiting, part, previous, None))
        if out:
            yield _batch(out, kind)

    kind = dict(ordered.dtypes)["conv_id"]
    return ordered.mapInArrow(cut, (
        f"key long, conv_id {kind}, part int, segment long, whole boolean, {_STATS_DDL}, audit string, "
        "turns array<struct<turn: long, role: string, text: string>>"))


def _whole_or_not(item: tuple, part: int, before: tuple | None, after: tuple | None) -> tuple:
    (conv, key), number, rows, ends = item
    inside = before is not None and after is not None and before != (conv, key) != after and ends
    head = (key, conv, part, number, inside)
    if not inside:
        return (*head, *[None] * len(_STATS), None, [tuple(r) for r in rows])
    return (*head, *_repaired_whole(rows))


def _repaired_whole(rows: list[Row]) -> tuple:
    if not rows:
        return (*[0] * len(_STATS), "", [])
    seen, repeated = set(), []
    for r in rows:
        repeated.append((r.role, r.text) in seen)
        seen.add((r.role, r.text))
    found = faults(rows, repeated)
    cost, audit = cheapest(found.codes)
    turns = [(None, *turn) for turn in repaired(rows, audit)[0]]
    return _gaps(found), found.blank, found.duplicate, found.truncated, found.illegal, cost, audit, turns


def _batch(out: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [pa.int64(), kind, pa.int32(), pa.int64(), pa.bool_(), *[pa.int64()] * len(_STATS), pa.string(), pa.list_(_TURN)]
    names = ["key", "conv_id", "part", "segment", "whole", *_STATS, "audit", "turns"]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)


def _repeats(cut: DataFrame) -> DataFrame:
    """(conv_id, part, segment, repeats): positions of rows whose role and text stand earlier in their conversation."""
    rows = cut.select("conv_id", "part", "segment", F.posexplode("turns").alias("position", "row"))
    marked = rows.select(
        "conv_id", "part", "segment", "position", F.sha2(F.col("row.text"), 256).alias("digest"), F.col("row.role").alias("role"))
    place = F.struct("part", "segment", "position")
    first = marked.groupBy("conv_id", "role", "digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    named = first.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    later = marked.join(named, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")))
    # A segment has SEGMENT_ROWS rows at most.
    return later.filter(place > F.col("first")).groupBy("conv_id", "part", "segment").agg(F.collect_list("position").alias("repeats"))


_FAULTS_DDL = ("codes string, blank long, duplicate long, truncated long, illegal long, low long, high long, turns long, "
               "first string, last string")


def _searched(cut: DataFrame) -> DataFrame:
    """(key, conv_id, part, segment, faults, ways): each segment's cheapest way between all states."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, ways = [], []
            for turns, repeats in zip(batch.column("turns").to_pylist(), batch.column("repeats").to_pylist(), strict=True):
                rows, again = [Row(**t) for t in turns], set(repeats or ())
                one = faults(rows, [k in again for k in range(len(rows))])
                found.append(one._asdict())
                pairs = [(entry, leave, cheapest(one.codes, entry, (leave,))) for entry in _STATES for leave in _STATES]
                ways.append([{"entry": e, "leave": x, "cost": way[0], "audit": way[1]} for e, x, way in pairs if way])
            kind = pa.list_(pa.struct([("entry", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
            facts = pa.struct([("codes", pa.string()), *((n, pa.int64()) for n in
                               ("blank", "duplicate", "truncated", "illegal", "low", "high", "turns")),
                               ("first", pa.string()), ("last", pa.string())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in ("key", "conv_id", "part", "segment")] + [pa.array(found, facts), pa.array(ways, kind)],
                ["key", "conv_id", "part", "segment", "faults", "ways"])

    conv = dict(cut.dtypes)["conv_id"]
    return cut.select("key", "conv_id", "part", "segment", "turns", "repeats").mapInArrow(search, (
        f"key long, conv_id {conv}, part int, segment long, faults struct<{_FAULTS_DDL.replace(' ', ': ').replace(',:', ',')}>, "
        "ways array<struct<entry: int, leave: int, cost: long, audit: string>>"))


class _Way:
    """The cheapest way so far into every state; what all ways have in common is kept once."""

    def __init__(self) -> None:
        self.common: list[str] = []
        self.tails: dict[int, tuple[int, str]] = {START: (0, "")}

    def extend(self, ways: list[dict]) -> None:
        fresh: dict[int, tuple[int, str]] = {}
        for way in ways:
            if way["entry"] in self.tails:
                cost, tail = self.tails[way["entry"]]
                fresh[way["leave"]] = min(fresh.get(way["leave"], (_FAR, "")), (cost + way["cost"], tail + way["audit"]))
        shared = os.path.commonprefix([tail for _, tail in fresh.values()])
        self.common.append(shared)
        self.tails = {state: (cost, tail[len(shared):]) for state, (cost, tail) in fresh.items()}

    def best(self) -> tuple[int, str]:
        cost, tail = min(self.tails[state] for state in _FINAL if state in self.tails)
        return cost, "".join(self.common) + tail


def _slices(codes: list[str], audit: str) -> Iterator[tuple[int, str]]:
    """The entry state and the part of the audit of each segment; insertions go to the segment before them."""
    at, state = 0, START
    for own in codes:
        entry, begin, taken = state, at, 0
        while at < len(audit) and (taken < len(own) or audit[at] == INSERT):
            letter = audit[at]
            if letter == KEEP:
                state = _STEP[state, own[taken].lower()]
            elif letter != DELETE:
                state = _FREE[state][1]
            taken += letter != INSERT
            at += 1
        yield entry, audit[begin:at]


def _folded(searched: DataFrame) -> DataFrame:
    """Per conversation (segment null) its stats and audit; per segment its entry state and slice of the audit."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for row in batch.to_pylist():
                    yield row

        kinds = [pa.int64(), None, pa.int32(), pa.int64(), pa.int32(), *[pa.int64()] * len(_STATS), pa.string()]
        names = ["key", "conv_id", "part", "segment", "entry", *_STATS, "audit"]
        kind = None
        for (key, conv), group in groupby(rows(), key=lambda r: (r["key"], r["conv_id"])):
            way, found, codes, places = _Way(), None, [], []
            for row in group:
                if row["faults"]["codes"]:
                    found = joined(found, Faults(**row["faults"]))._replace(codes="")
                way.extend(row["ways"])
                codes.append(row["faults"]["codes"])
                places.append((row["part"], row["segment"]))
            cost, audit = way.best()
            stats = [0] * 5 if found is None else [_gaps(found), found.blank, found.duplicate, found.truncated, found.illegal]
            out = [(key, conv, None, None, None, *stats, cost, audit)]
            for place, (entry, own) in zip(places, _slices(codes, audit), strict=True):
                out.append((key, conv, *place, entry, *[None] * len(_STATS), own))
            kind = conv_type
            for first in range(0, len(out), _BATCH):
                columns = zip(*out[first : first + _BATCH], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k or kind) for c, k in zip(columns, kinds, strict=True)], names)

    from pyspark.sql.pandas.types import to_arrow_type

    conv_type = to_arrow_type(searched.schema["conv_id"].dataType)
    dealt = searched.repartition("key").sortWithinPartitions("key", "conv_id", "part", "segment")
    return dealt.mapInArrow(fold, (
        f"key long, conv_id {dict(searched.dtypes)['conv_id']}, part int, segment long, entry int, {_STATS_DDL}, audit string"))


def _edited(cut: DataFrame, slices: DataFrame) -> DataFrame:
    """(key, conv_id, part, segment, turns): the segments' rows after their edits."""

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns = []
            for rows, entry, audit in zip(*(batch.column(n).to_pylist() for n in ("turns", "entry", "audit")), strict=True):
                done, _ = repaired([Row(**r) for r in rows], audit, entry)
                turns.append([(None, *turn) for turn in done])
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in ("key", "conv_id", "part", "segment")] + [pa.array(turns, pa.list_(_TURN))],
                ["key", "conv_id", "part", "segment", "turns"])

    named = slices.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.col("segment").alias("s"), "entry", "audit")
    both = cut.select("key", "conv_id", "part", "segment", "turns").join(
        named, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("segment") == F.col("s")))
    return both.drop("c", "p", "s").mapInArrow(edit, (
        f"key long, conv_id {dict(cut.dtypes)['conv_id']}, part int, segment long, "
        "turns array<struct<turn: long, role: string, text: string>>"))


class Repair(NamedTuple):
    """``audits`` (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) has a row per conversation.

    ``turns`` (conv_id, part, segment, whole, turns) has the repaired conversations
    as arrays of (role, text); one that is not ``whole`` goes on by part and segment.
    """

    audits: DataFrame
    turns: DataFrame


def repair_conversations(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    present: Column | None = None,
) -> Repair:
    """Audit and repair all conversations; rows that are not ``present`` only name theirs."""
    there = F.lit(True) if present is None else present
    pieces = stored(_segments(_ordered(df, conv, turn, role, text, there)))
    done, cut = pieces.filter("whole"), pieces.filter("NOT whole")
    named = _repeats(cut).select(
        F.col("conv_id").alias("c"), F.col("part").alias("p"), F.col("segment").alias("s"), "repeats")
    again = cut.join(named, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) &
                     (F.col("segment") == F.col("s")), "left")
    searched = _searched(again.filter("size(turns) > 0"))
    # A segment without rows still names its conversation.
    empty = cut.filter("size(turns) = 0").select("key", "conv_id", "part", "segment", _nothing(searched, "faults"), _still(searched))
    folded = stored(_folded(searched.unionByName(empty)))
    edited = _edited(cut, folded.filter("segment IS NOT NULL"))
    shown = "transform(turns, x -> struct(x.role AS role, x.text AS text)) AS turns"
    place = ["key", "conv_id", "part", "segment"]
    return Repair(
        done.select("conv_id", *_STATS, "audit").unionByName(folded.filter("segment IS NULL").select("conv_id", *_STATS, "audit")),
        done.selectExpr(*place, "whole", shown).unionByName(edited.selectExpr(*place, "false AS whole", shown)))


def _nothing(like: DataFrame, name: str) -> Column:
    kind = like.schema[name].dataType
    return F.from_json(F.lit('{"codes": "", "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0, '
                             '"first": "", "last": ""}'), kind).alias(name)


def _still(like: DataFrame) -> Column:
    """The ways through no rows: each state into itself."""
    ways = ", ".join(f'{{"entry": {s}, "leave": {s}, "cost": 0, "audit": ""}}' for s in _STATES)
    return F.from_json(F.lit(f"[{ways}]"), like.schema["ways"].dataType).alias("ways")


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``role:text`` lines. A cut conversation's segments run through one digest in order."""
    lines = F.transform("turns", lambda x: F.concat(x.role, F.lit(":"), x.text))
    whole = turns.filter("whole").select("conv_id", F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))
    cut = turns.filter("NOT whole").select("key", "conv_id", "part", "segment", F.array_join(lines, "\n").alias("lines"),
                                           (F.size("turns") > 0).alias("any"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(n).to_pylist() for n in ("key", "conv_id", "lines", "any")), strict=True)

        for (_, conv), group in groupby(rows(), key=lambda r: r[:2]):
            state, begun = hashlib.sha256(), False
            for _, _, text, any_ in group:
                if any_:
                    state.update(("\n" if begun else "").encode() + text.encode())
                    begun = True
            yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([state.hexdigest()])], ["conv_id", "repaired_sha256"])

    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(turns.schema["conv_id"].dataType)
    dealt = cut.repartition("key").sortWithinPartitions("key", "conv_id", "part", "segment")
    return whole.unionByName(dealt.mapInArrow(digest, f"conv_id {dict(turns.dtypes)['conv_id']}, repaired_sha256 string"))
