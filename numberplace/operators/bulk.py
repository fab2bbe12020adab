"""Answer a whole table of look-ups in one job.

A request is (request_id, location, field or null, offset, limit). It means
what one call of ``page_rows`` and ``page_summary`` means; an invalid request
gets an envelope with its error, as the others go on.

What a record answers depends on its search fields alone, so records are first
counted by the combination of those cells, which is combined on the map side.
The combinations, not the records, are then spread into (field, key) entries, one
per named field and one under ``*`` for each *different* key, so that a record
meets an any-field request once even when two of its fields agree. Requests come
first: records that hold none of their keys are passed over before anything is
grouped, entries that no request looks for are dropped at once, and only records
whose combination is asked for are read with all their columns.

A record travels as one struct to the end, so its columns may have any names but
those of the two that a page adds.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from numberplace import schema as S
from numberplace.functions.match import (
    NUMBER,
    key_cells,
    plain_columns,
    request_error,
    search_text,
    sql_text,
    with_number,
)
from numberplace.functions.ordering import range_order, record_order
from numberplace.operators.numbering import COPIES, START, number_rows
from numberplace.operators.paging import RETURNED_ROWS
from numberplace.session import stored

ANY = "*"

# Combinations of up to so many bytes are broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 64 * 1024 * 1024
# The largest group that is sorted in one task; beyond, rows are numbered by a
# range sort.
GROUP_ROWS = 1_000_000
# A combination that holds 1 / HOT_SHARE of all records is hot, and its records
# are split into SALTS parts by a shuffle.
HOT_SHARE = 1_000
SALTS = 200
# A level of a histogram splits a range of record numbers into 2 ** LEVEL_BITS parts.
LEVEL_BITS = 12
# Parts that a page touches are split again while one of them holds more rows.
REFINE_ROWS = 10_000
# Up to so many different keys are looked for in the records before these are grouped.
FILTER_KEYS = 1_000
# What a broadcast row takes besides its text: the hash table's and the row's own.
_ROW_BYTES = 128
# Stands for rows without a number; they come last.
_LAST = 2**63 - 1

# The rows per block in which pages and buckets meet.
BLOCK_ROWS = 1_000

_ENTRY = ["in_field", "key"]
_PART = [*_ENTRY, "bucket"]
_EACH = "explode(sequence({}, {}))"


def prepared(requests: DataFrame, fields: Sequence[str] = S.SEARCH_FIELDS) -> DataFrame:
    """Requests with the (``in_field``, ``key``) they look for, and their error."""
    checked = requests.select("*", request_error(fields).alias("error"))
    return checked.withColumn("location", search_text("location")).selectExpr(
        "request_id",
        "location",
        f"coalesce(field, '{S.ALL_FIELDS_LABEL}') AS field",
        "CAST(offset AS bigint) AS offset",
        "CAST(limit AS bigint) AS limit",
        f"coalesce(field, '{ANY}') AS in_field",
        "lower(location) AS key",
        "error",
    )


def combinations(
    df: DataFrame, fields: Sequence[str] = S.SEARCH_FIELDS, bucket: Column | None = None
) -> DataFrame:
    """The rows ``n`` behind every combination ``combo`` of cells (and each bucket)."""
    parts = [] if bucket is None else [bucket.alias("bucket")]
    rows = df.select(_combo(fields), *parts)
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


def _combo(fields: Sequence[str]) -> Column:
    """The search cells of a record as one struct; two are equal null by null.

    The cells are as they stand. Cutting and lower-casing them is left to the
    combinations, which are far fewer.
    """
    return F.struct(*(F.col(name).alias(f"cell{k}") for k, name in enumerate(fields))).alias("combo")


def entries(
    combined: DataFrame, fields: Sequence[str] = S.SEARCH_FIELDS, named: bool = True, anywhere: bool = True
) -> DataFrame:
    """Combinations spread into the (``in_field``, ``key``) entries that they answer.

    ``named`` and ``anywhere`` leave out entries that no request can look for.
    """
    keys = [f"lower(trim(combo.cell{k}))" for k in range(len(fields))]
    by_field = [f"struct({sql_text(name)} AS in_field, {key} AS key)" for name, key in zip(fields, keys)]
    by_any = f"transform(array_distinct(array({', '.join(keys)})), key -> struct('{ANY}' AS in_field, key AS key))"
    parts = [f"array({', '.join(by_field)})"] * named + [by_any] * anywhere
    return combined.selectExpr(
        *combined.columns, f"inline(concat({', '.join(parts)}))"
    ).filter("key IS NOT NULL")


def key_counts(df: DataFrame, fields: Sequence[str] = S.SEARCH_FIELDS) -> DataFrame:
    """The rows behind every (``in_field``, ``key``): what any request would find."""
    counted = entries(combinations(df, fields), fields)
    return counted.groupBy(*_ENTRY).agg(F.sum("n").alias("total"))


def bulk_lookup_summary(
    df: DataFrame, requests: DataFrame, fields: Sequence[str] = S.SEARCH_FIELDS
) -> DataFrame:
    """The envelope of every request; total 0 where nothing matches."""
    ready, asked = stored(prepared(requests, fields), **_halves())
    counted = _answering(df, ready.filter("error IS NULL"), fields, asked)[0].groupBy(*_ENTRY)
    answered = ready.join(counted.agg(F.sum("n").alias("total")), _ENTRY, "left")
    return (
        answered.withColumn("total", F.expr("IF(error IS NULL, coalesce(total, 0), NULL)"))
        # The smaller of a null and a number is the number, hence the test for null.
        .withColumn("returned", F.expr(f"IF(total IS NULL, NULL, {RETURNED_ROWS})"))
        .selectExpr(
            "request_id",
            "location",
            "field",
            "total",
            "offset",
            "returned",
            "offset + returned < total AS has_more",
            "error",
        )
    )


def bulk_lookup_rows(
    df: DataFrame,
    requests: DataFrame,
    fields: Sequence[str] = S.SEARCH_FIELDS,
    id_column: str = "record_id",
) -> DataFrame:
    """The page of every request: request_id, position from 1, the record.

    The position is null for limit 0, where every match is returned, in no order.
    """
    if taken := sorted({"request_id", "position"} & set(plain_columns(df))):
        raise ValueError(f"the records have columns of the names that a page adds: {taken}")
    valid, asked = stored(
        prepared(requests, fields).filter("error IS NULL"),
        **_halves(),
        whole=F.expr("count_if(limit = 0)"),
        paged=F.expr("count_if(limit > 0)"),
    )
    parts = []
    if asked["whole"] or not asked["paged"]:
        parts.append(_whole_rows(df, valid.filter("limit = 0"), fields, asked))
    if asked["paged"]:
        parts.append(_paged_rows(df, valid.filter("limit > 0"), fields, id_column, asked))
    return functools.reduce(DataFrame.unionByName, parts)


class Answers(NamedTuple):
    """``answers`` (answer_id, position, the record) of the different requests; ``members`` (request_id, answer_id)."""

    answers: DataFrame
    members: DataFrame


def bulk_lookup_answers(
    df: DataFrame,
    requests: DataFrame,
    fields: Sequence[str] = S.SEARCH_FIELDS,
    id_column: str = "record_id",
) -> Answers:
    """The pages of the different requests, each once, and which request has which.

    Requests are equal if they look for the same key in the same field and for the same
    page; with limit 0 the offset has no effect and does not count. Joined on
    ``answer_id``, both are what ``bulk_lookup_rows`` returns. A request with an error
    has no answer.
    """
    valid = prepared(requests, fields).filter("error IS NULL").withColumn("offset", F.expr("IF(limit = 0, 0, offset)"))
    same = [*_ENTRY, "offset", "limit"]
    distinct = stored(valid.groupBy(*same).agg(F.min("request_id").alias("answer_id"), F.first("location").alias("location")))
    asked = distinct.select(
        F.col("answer_id").alias("request_id"), "location",
        F.expr(f"nullif(in_field, '{ANY}')").alias("field"), "offset", "limit")
    rows = bulk_lookup_rows(df, asked, fields, id_column).withColumnRenamed("request_id", "answer_id")
    return Answers(rows, valid.join(distinct.select(*same, "answer_id"), same).select("request_id", "answer_id"))


def _halves() -> dict[str, Column]:
    """How many requests name a field, and how many look in any."""
    return {
        "named": F.expr(f"count_if(error IS NULL AND in_field <> '{ANY}')"),
        "anywhere": F.expr(f"count_if(error IS NULL AND in_field = '{ANY}')"),
    }


def _asked_only(df: DataFrame, wanted: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The records that hold a key which ``wanted`` looks for; all of them if there are too many keys to list."""
    keys = wanted.select(*_ENTRY).distinct().limit(FILTER_KEYS + 1).collect()
    if len(keys) > FILTER_KEYS:
        return df
    holds = F.lit(False)
    for name, cell in key_cells(df, fields).items():
        if sought := sorted({row.key for row in keys if row.in_field in (name, ANY)}):
            holds = holds | cell.isin(sought)
    return df.filter(holds)


def _answering(df: DataFrame, wanted: DataFrame, fields: Sequence[str], asked: dict) -> tuple[DataFrame, dict]:
    """The entries (combo, n, in_field, key) that ``wanted`` looks for, stored, and measures of the records behind them.

    These are their number ``rows`` and, if they have numbers, the ``low`` and ``high`` one.
    """
    numbers = {}
    if NUMBER in df.columns:
        numbers = {"low": F.min(NUMBER), "high": F.max(NUMBER)}
    if not (asked["named"] or asked["anywhere"]):
        return stored(entries(combinations(df, fields).limit(0), fields)), {"rows": 0, "low": None, "high": None}
    held = _asked_only(df, wanted, fields)
    counted = held.select(_combo(fields), *numbers and [NUMBER]).groupBy("combo").agg(
        F.count(F.lit(1)).alias("n"), *(value.alias(name) for name, value in numbers.items()))
    everything = Observation()
    ends = [F.min("low").alias("low"), F.max("high").alias("high")] if numbers else []
    combined = counted.observe(everything, F.sum("n").alias("rows"), *ends).drop(*numbers)
    spread = entries(combined, fields, bool(asked["named"]), bool(asked["anywhere"]))
    found = stored(spread.join(wanted.select(*_ENTRY).distinct(), _ENTRY, "left_semi"))
    return found, {"low": None, "high": None} | everything.get | {"rows": everything.get["rows"] or 0}


def _whole_rows(df: DataFrame, whole: DataFrame, fields: Sequence[str], asked: dict) -> DataFrame:
    answering, measured = _answering(df, whole, fields, asked)
    met = answering.join(whole, _ENTRY).select("combo", "request_id")
    hits = _join(df.select(_combo(fields), _record(df)), met, ["combo"], answering, measured["rows"])
    return hits.selectExpr("request_id", "CAST(NULL AS bigint) AS position", "record.*")


def _paged_rows(df: DataFrame, paged: DataFrame, fields: Sequence[str], id_column: str, asked: dict) -> DataFrame:
    """Pages, located by histograms of the record number before rows are read.

    Each asked key's rows are counted per part of the range of numbers, so the position
    at which a part starts is known. Parts that pages touch are split again, and only
    they, until none holds more than ``REFINE_ROWS`` rows or numbers separate no
    further; numbers far away from the others cost a level, no more. What the pages
    then touch is read and ranked. A hot key is counted, never collected in one place.
    """
    df = with_number(df, id_column)
    order = record_order(df, id_column, "record")
    pages = paged.selectExpr("request_id", *_ENTRY, "offset", "offset + limit AS last")
    wanted = pages.groupBy(*_ENTRY).agg(F.min("offset").alias("low"), F.max("last").alias("high"))
    answering, measured = _answering(df, paged, fields, asked)
    rows, low, high = measured["rows"], measured["low"], measured["high"]
    shift = 0 if low is None else max(0, (high - low).bit_length() - LEVEL_BITS)

    asked_combos = answering.select("combo").distinct()
    places = df.select(_combo(fields), _bucket(shift).alias("bucket"))
    combined = _counted(_join(places, asked_combos, ["combo"], answering, rows), ["combo", "bucket"])
    spread = combined.join(answering.drop("n"), "combo").withColumn("base", F.lit(0).cast("bigint"))
    spans, groups = _spans(spread, pages, wanted, [])
    while shift and (groups["biggest"] or 0) > REFINE_ROWS:
        finer = max(0, shift - LEVEL_BITS)
        parents = spans.select(*_ENTRY, F.col("bucket").alias("parent"), F.col("start").alias("base")).distinct()
        met = combined.withColumnRenamed("bucket", "parent").drop("n").join(answering.drop("n"), "combo").join(
            parents, [*_ENTRY, "parent"]).select("combo", "parent").distinct()
        places = df.select(_combo(fields), _bucket(shift).alias("parent"), _bucket(finer).alias("bucket"))
        heavy = combined.withColumnRenamed("bucket", "parent")
        combined = _counted(_join(places, met, ["combo", "parent"], heavy, rows), ["combo", "parent", "bucket"])
        spread = combined.join(answering.drop("n"), "combo").join(parents, [*_ENTRY, "parent"])
        spans, groups = _spans(spread, pages, wanted, ["parent", "base"])
        combined, shift = combined.drop("parent"), finer

    touched = spans.select(*_PART, "start").distinct()
    met = combined.join(answering.drop("n"), "combo").join(touched, _PART).select("combo", *_PART, "start")
    records = df.select(_combo(fields), _bucket(shift).alias("bucket"), _record(df), NUMBER)
    hits = _join(records, met, ["combo", "bucket"], combined, rows).select(*_PART, "start", "record", NUMBER)

    if (groups["biggest"] or 0) <= GROUP_ROWS:
        hits = hits.withColumn("rank", F.row_number().over(Window.partitionBy(*_PART).orderBy(*order)))
        ranked = hits.withColumn("position", F.expr("start + rank"))
        each = spans.selectExpr("request_id", *_ENTRY, f"{_EACH.format('first + 1', 'last')} AS position")
        return ranked.join(each, [*_ENTRY, "position"]).select("request_id", "position", "record.*")

    numbered = number_rows(hits, _PART, order, range_order(df, id_column, "record")).withColumnRenamed("start", "part_start")
    numbered = numbered.withColumn("at", F.expr(f"part_start + {START}"))
    placed = numbered.join(spans.drop("start"), _PART).filter(f"at < last AND at + {COPIES} > first")
    shared = _EACH.format("greatest(at, first) + 1", f"least(at + {COPIES}, last)")
    return placed.select("request_id", F.expr(f"{shared} AS position"), "record").select(
        "request_id", "position", "record.*"
    )


def _counted(places: DataFrame, keys: list[str]) -> DataFrame:
    return stored(places.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))


def _spans(spread: DataFrame, pages: DataFrame, wanted: DataFrame, within: list[str]) -> tuple[DataFrame, dict]:
    """For each request the buckets that hold its page and its positions in them, stored; the rows of the ``biggest``.

    Buckets follow each other from ``base`` on, by themselves in each group of ``within``.
    Requests and buckets are intervals of positions. They meet by the blocks of
    positions that they touch, so that no request is compared with all buckets
    of its key; of the blocks that a pair shares only the first one counts.
    """
    sized = spread.groupBy(*_PART, "base", *(c for c in within if c != "base")).agg(F.sum("n").alias("rows")).join(wanted, _ENTRY)
    before = Window.partitionBy(*_ENTRY, *within).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sized.withColumn("start", F.col("base") + F.coalesce(F.sum("rows").over(before), F.lit(0)))
    near = starts.filter("start < high AND start + rows > low").selectExpr(
        *_PART,
        "start",
        "rows",
        _EACH.format(
            f"greatest(start, low) div {BLOCK_ROWS}", f"(least(start + rows, high) - 1) div {BLOCK_ROWS}"
        )
        + " AS block",
    )
    blocks = _EACH.format(f"offset div {BLOCK_ROWS}", f"(last - 1) div {BLOCK_ROWS}")
    return stored(
        near.join(pages.selectExpr("*", f"{blocks} AS block"), [*_ENTRY, "block"])
        .withColumns({"first": F.expr("greatest(offset, start)"), "last": F.expr("least(last, start + rows)")})
        .filter(f"first < last AND block = first div {BLOCK_ROWS}")
        .select("request_id", *_PART, "start", "rows", "first", "last"),
        biggest=F.max("rows"),
    )


def _bucket(shift: int) -> Column:
    """The part of the range of record numbers that a row is in; no number, last part.

    A right shift keeps the order of numbers and cannot overflow.
    """
    return F.coalesce(F.shiftright(F.col(NUMBER), shift), F.lit(_LAST))


def _record(df: DataFrame) -> Column:
    return F.struct(*(F.col(f"`{c}`") for c in plain_columns(df))).alias("record")


def _join(
    records: DataFrame, met: DataFrame, on: list[str], combined: DataFrame, rows: int
) -> DataFrame:
    """The records of the combinations in ``met``, once for each of its rows.

    The bytes of ``met`` are summed up first. Few are broadcast; otherwise both
    sides are shuffled, with the records of hot combinations split by salt.
    Combinations share no records, so at most HOT_SHARE of them are hot, and
    their list is small whatever the tables are.
    """
    # Each text twice over, since it may be held in two bytes a character.
    held = F.lit(_ROW_BYTES) + 2 * F.octet_length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    met, size = stored(met, bytes=F.sum(held))
    if (size["bytes"] or 0) <= BROADCAST_BYTES:
        return records.join(F.broadcast(met), on)

    hot = combined.filter(F.col("n") * HOT_SHARE >= rows).select(*on, F.lit(SALTS).alias("salts")).distinct()
    # The row's number in its task and not a hash of the record, so that copies
    # and the rows of one task spread too; a repeated task numbers them alike.
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.coalesce("salts", F.lit(1)))
    salted = _with_salts(records, hot, on).withColumn("salt", salt).drop("salts")
    copies = F.expr("explode(sequence(0L, coalesce(salts, 1) - 1L))")
    copied = _with_salts(met, hot, on).withColumn("salt", copies).drop("salts")
    return salted.join(copied, [*on, "salt"]).drop("salt")


def _with_salts(df: DataFrame, hot: DataFrame, on: list[str]) -> DataFrame:
    return df.join(F.broadcast(hot), on, "left")
