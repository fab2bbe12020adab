"""The total order that pages are cut from.

Record ids are ordered as numbers where they are numbers, then as text, then by
the other columns, nulls last throughout. Only identical rows tie.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from numberplace.functions.match import NUMBER, number_of, plain_columns


#: Characters of a text that tell rows apart when they are dealt out by range.
RANGE_WIDTH = 32


def _names(df: DataFrame, id_column: str) -> list[str]:
    return [id_column, *(c for c in plain_columns(df) if c != id_column)]


def record_order(df: DataFrame, id_column: str = "record_id", record: str | None = None) -> list[Column]:
    """The sort columns of the record order of ``df``, which has its record number.

    With ``record`` they are taken from a struct column of that name that holds
    the plain columns of ``df``, beside the number. A column that holds a map
    has no order and is refused.
    """
    for field in df.schema:
        if _holds_map(field.dataType):
            raise ValueError(f"column {field.name} holds a map, which has no order; pages cannot be cut")
    cells = [F.col(f"`{c}`") if record is None else F.col(record).getField(c) for c in _names(df, id_column)]
    return [c.asc_nulls_last() for c in (F.col(NUMBER), *cells)]


def range_order(df: DataFrame, id_column: str = "record_id", record: str | None = None) -> list[Column]:
    """Sort columns of a fixed width that agree with ``record_order``: the beginnings of texts.

    Rows that agree in them belong together; only up to the first column whose
    values have no fixed width or beginning.
    """
    out = [F.col(NUMBER).asc_nulls_last()]
    for name in _names(df, id_column):
        kind = df.schema[name].dataType
        cell = F.col(f"`{name}`") if record is None else F.col(record).getField(name)
        if isinstance(kind, T.StringType):
            cell = F.substring(cell, 1, RANGE_WIDTH)
        elif not isinstance(kind, (T.NumericType, T.DatetimeType, T.BooleanType)):
            break
        out.append(cell.asc_nulls_last())
        if isinstance(kind, T.StringType) and type(kind) is not T.StringType:
            break  # of another collation
    return out


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(field.dataType) for field in kind)
    return isinstance(kind, T.MapType)


def from_row(df: DataFrame, row: Mapping, id_column: str = "record_id") -> Column:
    """``row`` itself, its copies, and the rows that come after it in the record order.

    The bound on the number stands in front by itself: where that is a stored
    column, the bound is pushed into the scan. The number is asked for as seldom as
    can be, since a filter works it out anew each time. The other columns are compared
    for equal numbers only, as structs, which compare field by field; the null
    flag before each field puts nulls last.
    """
    number = F.col(NUMBER)
    bound = number_of(row[id_column])
    names = _names(df, id_column)
    tie = _flagged([F.col(f"`{name}`") for name in names]) >= _flagged([_cell(df, name, row) for name in names])
    if bound is None:
        return number.isNull() & tie
    return (number.isNull() | (number >= bound)) & (~number.eqNullSafe(bound) | tie)


def _cell(df: DataFrame, name: str, row: Mapping) -> Column:
    return F.lit(row[name]).cast(df.schema[name].dataType)


def _flagged(values: list[Column]) -> Column:
    fields = []
    for k, value in enumerate(values):
        fields += [value.isNull().alias(f"null{k}"), value.alias(f"value{k}")]
    return F.struct(*fields)
