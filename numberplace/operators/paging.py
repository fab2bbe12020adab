"""Look up records by place, operator or code: full match, page, envelope."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from numberplace import schema as S
from numberplace.functions.match import (
    NUMBER,
    check_request,
    match_predicate,
    plain_columns,
    with_number,
)
from numberplace.functions.ordering import from_row, range_order, record_order
from numberplace.operators.numbering import cut, number_rows
from numberplace.session import stored

# A page that ends within so many rows needs no exact start.
DIRECT_ROWS = 1_000
# More rows than these around a page are numbered by a range sort.
CANDIDATE_ROWS = 100_000
# The sketch of the record numbers errs by one of so many rows at most.
ACCURACY = 25_000
# Marks that are read off the sketch, evenly and, close to both ends, by doubling.
_EVEN_MARKS = 512
_BUCKET_BITS = 12

# The rows on a page, worked out from the total alone.
RETURNED_ROWS = "IF(limit = 0, total, greatest(0, least(limit, total - offset)))"


def find_records(
    df: DataFrame,
    location: str,
    field: str | None = None,
    fields: Sequence[str] = S.SEARCH_FIELDS,
) -> DataFrame:
    """Every row that matches, with all its columns. A narrow filter."""
    check_request(location, field, 0, 0, fields)
    return df.filter(match_predicate(df, location, field, fields)).select(*(f"`{c}`" for c in plain_columns(df)))


def page_rows(
    df: DataFrame,
    location: str,
    field: str | None = None,
    offset: int = 0,
    limit: int = S.DEFAULT_LIMIT,
    fields: Sequence[str] = S.SEARCH_FIELDS,
    id_column: str = "record_id",
) -> DataFrame:
    """One page of the match in record order; limit 0 is the full match.

    With limit 0 the offset has no effect and the rows come in no order.
    """
    check_request(location, field, offset, limit, fields)
    rows = df.filter(match_predicate(df, location, field, fields))
    if limit == 0:
        return rows.select(*(f"`{c}`" for c in plain_columns(df)))
    return cut_page(rows, offset, limit, id_column)


def page_summary(
    df: DataFrame,
    location: str,
    field: str | None = None,
    offset: int = 0,
    limit: int = S.DEFAULT_LIMIT,
    fields: Sequence[str] = S.SEARCH_FIELDS,
) -> DataFrame:
    """The envelope of a page: one row, from one count over the search columns."""
    check_request(location, field, offset, limit, fields)
    predicate = match_predicate(df, location, field, fields)
    return (
        df.filter(predicate)
        .agg(F.count(F.lit(1)).alias("total"))
        .select(
            F.lit(location.strip()).alias("location"),
            F.lit(field or S.ALL_FIELDS_LABEL).alias("field"),
            "total",
            F.lit(offset).cast("bigint").alias("offset"),
            F.lit(limit).cast("bigint").alias("limit"),
        )
        .selectExpr("location", "field", "total", "offset", f"{RETURNED_ROWS} AS returned")
        .selectExpr("*", "offset + returned < total AS has_more")
    )


def page_after(
    df: DataFrame,
    location: str,
    after: Mapping | Row,
    seen: int = 1,
    field: str | None = None,
    limit: int = S.DEFAULT_LIMIT,
    fields: Sequence[str] = S.SEARCH_FIELDS,
    id_column: str = "record_id",
) -> DataFrame:
    """The page that follows the row ``after``; the rows before it are not sorted.

    ``seen`` is the number of copies of ``after`` on the pages before, which
    ``cursor`` counts; further copies of it start this page.
    """
    check_request(location, field, 0, limit, fields)
    if limit == 0:
        raise ValueError("a page after a row needs a limit above 0")
    if isinstance(after, Row):
        after = after.asDict()
    rows = with_number(df.filter(match_predicate(df, location, field, fields)), id_column)
    return cut_page(rows.filter(from_row(rows, after, id_column)), seen, limit, id_column)


def cursor(page: Sequence[Row], previous: tuple[Row, int] | None = None) -> tuple[Row, int] | None:
    """``after`` and ``seen`` for the page that follows the collected ``page``."""
    if not page:
        return previous
    last = page[-1]
    seen = sum(1 for row in page if row == last)
    if previous and previous[0] == last:
        seen += previous[1]
    return last, seen


def cut_page(rows: DataFrame, offset: int, limit: int, id_column: str = "record_id") -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of ``rows`` in record order.

    A first pass folds the record numbers into a quantile sketch, whose tasks'
    parts merge and whose rank error has a bound. It gives a number that the page
    surely ends before; a near page is the top-k of the rows up to there, so a task
    keeps a heap of the few that remain, and nothing is sorted.

    For a deep page the sketch also gives a number that the page surely starts
    behind. A second pass counts the rows before that one and takes a histogram in
    between, a few thousand counts, which give the exact range of numbers that holds
    the page; the third pass reads that range alone. Where numbers cannot separate
    rows, because they repeat or the ids are no numbers, the rest is numbered with a
    range sort.
    """
    rows = with_number(rows, id_column)
    return _page(rows, offset, limit, id_column, _sketch(rows))


def _page(rows: DataFrame, offset: int, limit: int, id_column: str, sketch: Sketch) -> DataFrame:
    if offset + limit <= DIRECT_ROWS:
        inside, skip, size = sketch.near(offset + limit), offset, 0
    else:
        inside, skip, size = _locate(rows, offset, limit, sketch)
    order = record_order(rows, id_column, "record")
    candidates = _packed(rows.filter(inside))
    if size > CANDIDATE_ROWS:
        numbered = number_rows(candidates, [], order, range_order(rows, id_column, "record"))
        return cut(numbered, F.lit(skip), F.lit(skip + limit)).orderBy(*order).select("record.*")
    return candidates.orderBy(*order).offset(skip).limit(limit).select("record.*")


def _packed(rows: DataFrame) -> DataFrame:
    """The caller's columns as one struct, ``record``, beside the record number."""
    return rows.select(F.struct(*(F.col(f"`{c}`") for c in plain_columns(rows))).alias("record"), NUMBER)


def lookup(
    df: DataFrame,
    location: str,
    field: str | None = None,
    offset: int = 0,
    limit: int = S.DEFAULT_LIMIT,
    fields: Sequence[str] = S.SEARCH_FIELDS,
    id_column: str = "record_id",
) -> DataFrame:
    """The envelope of a page with its ``records``, an array in record order: one row.

    The count comes from the pass that takes the sketch. A limit of 0 has no bound
    on its rows and is refused; ``page_rows`` and ``page_summary`` serve it.
    """
    check_request(location, field, offset, limit, fields)
    if limit == 0:
        raise ValueError("records come as an array for a limit above 0 only")
    rows = with_number(df.filter(match_predicate(df, location, field, fields)), id_column)
    sketch = _sketch(rows)
    page = stored(_page(rows, offset, limit, id_column, sketch))
    numbered = with_number(page, id_column)
    cells = F.struct(F.row_number().over(Window.orderBy(*record_order(numbered, id_column))).alias("at"),
                     F.struct(*(F.col(f"`{c}`") for c in page.columns)).alias("record"))
    # At most MAX_LIMIT rows.
    records = numbered.select(cells.alias("cell")).agg(F.sort_array(F.collect_list("cell")).alias("cells"))
    return records.select(
        F.lit(location.strip()).alias("location"),
        F.lit(field or S.ALL_FIELDS_LABEL).alias("field"),
        F.lit(sketch.rows).cast("bigint").alias("total"),
        F.lit(offset).cast("bigint").alias("offset"),
        F.lit(limit).cast("bigint").alias("limit"),
        F.transform("cells", lambda cell: cell.record).alias("records"),
    ).selectExpr("location", "field", "total", "offset", f"{RETURNED_ROWS} AS returned", "records").selectExpr(
        "location", "field", "total", "offset", "returned", "offset + returned < total AS has_more", "records")


class Sketch(NamedTuple):
    """How many rows there are, how many have a number, and numbers at known shares of these.

    Each of ``marks`` (share, number) has a rank within ``error`` of its share of the rows.
    """

    rows: int
    numbered: int
    marks: list[tuple[float, int]]
    error: float

    def near(self, end: int) -> Column:
        """A filter that lets the first ``end`` rows through."""
        return F.col(NUMBER) <= self.above(end) if end <= self.numbered else F.lit(True)

    def above(self, rank: int) -> int:
        """A number with at least ``rank`` rows up to it."""
        surely = (number for share, number in self.marks if math.floor((share - self.error) * self.numbered) >= rank)
        return next(surely, self.marks[-1][1])

    def below(self, rank: int) -> int:
        """A number with at most ``rank`` rows before it."""
        surely = [number for share, number in self.marks if math.ceil((share + self.error) * self.numbered) <= rank]
        return surely[-1] if surely else self.marks[0][1]


def _shares() -> list[float]:
    """0, 1 and the shares between at which numbers are read off the sketch."""
    ends = [4 * 2**k / ACCURACY for k in range(64) if 4 * 2**k < ACCURACY // 2]
    return sorted({k / _EVEN_MARKS for k in range(_EVEN_MARKS + 1)} | set(ends) | {1 - share for share in ends})


def _sketch(rows: DataFrame) -> Sketch:
    """One pass over the record numbers alone."""
    shares = _shares()
    # The sketch's shares need not reach the outermost numbers, hence both ends by themselves.
    quantiles = F.expr(f"percentile_approx(`{NUMBER}`, array({', '.join(f'{share!r}D' for share in shares)}), {ACCURACY})")
    number = F.col(NUMBER)
    found = rows.agg(F.count(F.lit(1)).alias("rows"), F.count(number).alias("numbered"), F.min(number).alias("low"),
                     F.max(number).alias("high"), quantiles.alias("marks")).first()
    inner = list(zip(shares, found.marks or []))[1:-1]
    marks = [(0.0, found.low), *inner, (1.0, found.high)] if found.numbered else []
    # Twice the stated error, as merged sketches are allowed to round.
    return Sketch(found.rows, found.numbered, marks, 2 / ACCURACY)


def _locate(rows: DataFrame, offset: int, limit: int, sketch: Sketch) -> tuple[Column, int, int]:
    """Where a page lies: a filter on the number, the rows to skip inside, their count."""
    number = F.col(NUMBER)
    unnumbered = sketch.rows - sketch.numbered
    end = min(offset + limit, sketch.rows)
    if offset >= end:
        return F.lit(False), 0, 0
    if offset >= sketch.numbered:  # rows without a number come last
        return number.isNull(), offset - sketch.numbered, unnumbered

    low, high = sketch.below(offset), sketch.above(min(end, sketch.numbered))
    # A right shift keeps the order and cannot overflow.
    shift = max(0, (high - low).bit_length() - _BUCKET_BITS)
    bucket = F.when(number >= low, F.shiftright(number, shift))
    counts = rows.filter(number <= high).groupBy(bucket.alias("bucket")).count().collect()  # at most 2 ** 12 + 2 rows
    before = sum(row[1] for row in counts if row.bucket is None)
    first, last, skip, size = _overlap(sorted(tuple(row) for row in counts if row.bucket is not None), offset - before, limit)
    inside = number.between(max(low, first << shift), min(high, (last + 1 << shift) - 1))
    if end > sketch.numbered:
        return inside | number.isNull(), skip, size + unnumbered
    return inside, skip, size


def _overlap(buckets: Sequence[tuple[int, int]], skip: int, limit: int) -> tuple[int, int, int, int]:
    """First and last bucket of a page, the rows to skip in them, and their rows."""
    position, before, size, touched = 0, 0, 0, []
    for bucket, rows in buckets:
        if position + rows <= skip:
            before += rows
        elif position < skip + limit:
            touched.append(bucket)
            size += rows
        position += rows
    return touched[0], touched[-1], skip - before, size
