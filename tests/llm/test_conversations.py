import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from numberplace.llm import conversations as C
from numberplace.llm import queries as Q

from .conftest import SF, rows_of

LEGAL = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string"


def hurt(rows):
    """The damage of the query, row by row; {conv_id: [(turn, role, text)]} in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            out[conv] += []
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv in out:
        out[conv].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def slow(rows):
    """The expected row by best-first search over whole prefixes, on the written contract alone."""
    seen, kinds = set(), []
    for _, role, text in rows:
        spoken = re.sub(r"[\x20\x09-\x0D]", "", text)
        kinds.append("blank" if not spoken else "duplicate" if (role, text) in seen else "truncated" if spoken[-1] not in ".!?" else "")
        seen.add((role, text))
    heap, best, done = [(0, "", 0, ())], None, {}
    while heap:
        cost, audit, at, turns = heapq.heappop(heap)
        if best is not None and cost > best[0]:
            break
        initials = "".join(r[:1] or "?" for r, _ in turns)
        node = (at, initials[-1:], initials in ("", "s"))
        if done.setdefault(node, (cost, audit)) < (cost, audit):
            continue
        if at == len(rows) and LEGAL.match(initials):
            best = min(best, (cost, audit, turns)) if best else (cost, audit, turns)
        ways = [("I", 2, 0, (r, "")) for r in ("user", "assistant")]
        if at < len(rows):
            _, role, text = rows[at]
            ways.append(("D", 3, 1, None))
            if kinds[at] in ("", "truncated"):
                extra = kinds[at] == "truncated"
                ways += [("K", extra, 1, (role, text)), *(("R", 2 + extra, 1, (r, text)) for r in ("user", "assistant"))]
        for letter, paid, taken, turn in ways:
            more = turns + ((turn,) if turn else ())
            names = [r[:1] or "?" for r, _ in more]
            if "".join(names[-2:]) in ("su", "ua", "au") or len(names) < 2 and names in ([], ["s"], ["u"]) or turn is None:
                heapq.heappush(heap, (cost + paid, audit + letter, at + taken, more))
    cost, audit, turns = best
    given = [t for t, _, _ in rows if t is not None]
    pairs = [(a[1][:1] + b[1][:1]) for a, b in zip(rows, rows[1:])]
    text = "\n".join(f"{r}:{t}" for r, t in turns)
    return (max(given) - min(given) + 1 - len(set(given)) if given else 0, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest())


def found(df):
    repair = C.repair_conversations(Q.damaged(df), present=F.col("present"))
    digests = C.digests(repair.turns).withColumnRenamed("conv_id", "c")
    both = repair.audits.join(digests, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    return rows_of(both.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))


def expected(rows):
    return sorted(((conv, *slow(own)) for conv, own in hurt(rows).items()), key=repr)


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = rows_of(Q.op12_conversation_repair(spark, SF).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
    assert got == expected(rows) and any("I" in r[7] for r in got) and any("D" in r[7] for r in got)


def chance_rows(rng, conversations, most):
    texts = ["Yes.", "No!", "why", " ", "", None, "So?", "x" * 2_000 + ".", "tail \n", "Well.", "Fine. ", "Oh"]
    rows = []
    for conv in [None, *range(conversations)]:
        for k in range(rng.randint(1, most)):
            rows.append((conv, rng.choice([k, k, k, k + 2, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "s"]),
                         rng.choice(texts)))
    return rows + rows[:3] * 2


@pytest.mark.parametrize("segment", [512, 3])
def test_chance_conversations(spark, clashing, monkeypatch, segment):
    monkeypatch.setattr(C, "SEGMENT_ROWS", segment)
    rows = chance_rows(random.Random(segment), 60, 9)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(df) == expected(rows)
    assert found(clashing(df)) == expected(rows)
    assert found(df.limit(0)) == []


def test_one_conversation_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(C, "SEGMENT_ROWS", 100)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(5)
    turns = [(7, k, rng.choice(["user", "assistant", "assistant", "system"]), f"{rng.choice('abc')}{k % 1_900} {rng.choice(['.', ''])}")
             for k in range(3_000)]
    turns += [(7, None, "user", "The same row.")] * 1_500 + [(8, 1, "user", "Alone.")]
    df = spark.createDataFrame(turns, SCHEMA).repartition(8)
    whole = {r[0]: r for r in found(df)}
    damaged = hurt(turns)
    rows = [C.Row(*r) for r in damaged[7]]
    seen, again = set(), []
    for r in rows:
        again.append((r.role, r.text) in seen)
        seen.add((r.role, r.text))
    facts = C.faults(rows, again)
    cost, audit = C.cheapest(facts.codes)
    text = "\n".join(f"{r}:{t}" for r, t in C.repaired(rows, audit)[0])
    assert whole[7][1:] == (C._gaps(facts), facts.blank, facts.duplicate, facts.truncated, facts.illegal, cost, audit,
                            hashlib.sha256(text.encode()).hexdigest())
    assert C._segments(C._ordered(Q.damaged(df), "conv_id", "turn", "role", "text", F.col("present"))).filter(
        "conv_id = 7").select("part").distinct().count() > 2
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_search_against_all_edits():
    rng = random.Random(1)
    for _ in range(300):
        codes = "".join(rng.choice("suaSUAox") for _ in range(rng.randint(0, 6)))
        ways, level = {(0, C.START): (0, "")}, None
        best = {}
        for _ in range(2 * len(codes) + 4):
            level = {}
            for (at, state), (cost, audit) in ways.items():
                if at == len(codes):
                    best[state] = min(best.get(state, (99, "")), (cost, audit))
                for letter, paid, taken, after in C._edits(codes[at] if at < len(codes) else None, state):
                    new = (cost + paid, audit + letter)
                    key = (at + taken, after)
                    level[key] = min(level.get(key, (99, "")), new)
            ways = level
        assert C.cheapest(codes) == min(best[s] for s in (C.START, C.ASSISTANT) if s in best), codes
