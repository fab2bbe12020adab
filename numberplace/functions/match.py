"""Predicates over the search fields, and the checks on what is asked for.

A search text loses all Unicode whitespace at its ends, a cell only U+0020;
both are lower-cased and then have to be equal as a whole. Statistics compare
province and city exactly instead.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from numberplace import schema as S

# Names of the columns that this package adds, and the metadata that tells them
# from a caller's own. Metadata is stored with a Parquet table and read back.
KEY_PREFIX = "_numberplace_key_"
NUMBER = "_numberplace_number"
KEY_OF = "numberplace.key_of"
NUMBER_OF = "numberplace.number_of"


def normalise(text: str) -> str:
    """The comparison key of one search text."""
    return text.strip().lower()


def search_text(column: str | Column) -> Column:
    """A column of search texts without the whitespace that Python strips."""
    column = F.col(column) if isinstance(column, str) else column
    return F.btrim(column, F.lit(S.PY_WHITESPACE))


def cell_key(field: str) -> Column:
    """The comparison key of a cell."""
    return F.lower(F.trim(F.col(field)))


def as_number(text: Column) -> Column:
    """The whole number that a text holds, else null.

    The pattern is tested first: a cast that fails costs far more than one that
    succeeds, and a table may have no number among its ids.
    """
    return F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), text).try_cast("bigint")


def number_of(value: object) -> int | None:
    """What ``as_number`` makes of one value."""
    found = re.fullmatch(r"[ \t\n\v\f\r]*([+-]?[0-9]+)[ \t\n\v\f\r]*", "" if value is None else str(value))
    number = int(found[1]) if found else None
    return number if number is not None and -(2**63) <= number < 2**63 else None


def with_number(df: DataFrame, record_id: str = "record_id") -> DataFrame:
    """Add the record id as a number. It serves the order only.

    A column of its own is worked out once per row, an expression in a sort
    order once per comparison. A caller's own column of that name is refused.
    """
    if _marked(df, NUMBER_OF).get(record_id) == NUMBER:
        return df
    whole = isinstance(df.schema[record_id].dataType, T.IntegralType)
    number = F.col(record_id).cast("bigint") if whole else as_number(F.col(record_id))
    return _added(df, {NUMBER: (number, {NUMBER_OF: record_id})})


def with_keys(
    df: DataFrame, fields: Sequence[str] = S.SEARCH_FIELDS, record_id: str | None = "record_id"
) -> DataFrame:
    """Add a key column per field, and the record number for the order of pages.

    Stored in Parquet they turn a search into plain comparisons of columns,
    which reach the scan as pushed filters. The metadata of a key column names
    its field; a cell that is changed later needs its keys made anew.
    """
    keyed = _added(df, {KEY_PREFIX + field: (cell_key(field), {KEY_OF: field}) for field in fields})
    return with_number(keyed, record_id) if record_id else keyed


def _added(df: DataFrame, columns: Mapping[str, tuple[Column, dict[str, str]]]) -> DataFrame:
    own = {field.name for field in df.schema if not _is_added(field)}
    if taken := sorted(own & set(columns)):
        raise ValueError(f"these column names are reserved: {taken}")
    df = df.withColumns({name: value for name, (value, _) in columns.items()})
    for name, (_, metadata) in columns.items():
        df = df.withMetadata(name, metadata)
    return df


def _is_added(field: T.StructField) -> bool:
    return KEY_OF in field.metadata or NUMBER_OF in field.metadata


def _marked(df: DataFrame, mark: str) -> dict[str, str]:
    """The columns that this package added, by the column that each was made from."""
    return {field.metadata[mark]: field.name for field in df.schema if mark in field.metadata}


def sql_text(text: str) -> str:
    """``text`` as a literal inside an SQL expression."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def key_column(field: str) -> str:
    return KEY_PREFIX + field


def plain_columns(df: DataFrame) -> list[str]:
    """The caller's columns of ``df``, all but those that this package added."""
    return [field.name for field in df.schema if not _is_added(field)]


def pair_predicate(
    province: str = S.DEFAULT_PROVINCE,
    city: str = S.DEFAULT_CITY,
    columns: tuple[str, str] = ("province", "city"),
) -> Column:
    """Exact equality of two columns with a pair of values."""
    return (F.col(columns[0]) == province) & (F.col(columns[1]) == city)


def key_cells(df: DataFrame, fields: Sequence[str]) -> dict[str, Column]:
    """The comparison keys of ``fields``, stored ones where ``df`` has them."""
    stored = _marked(df, KEY_OF)
    return {name: F.col(stored[name]) if name in stored else cell_key(name) for name in fields}


def match_predicate(
    df: DataFrame,
    location: str,
    field: str | None = None,
    fields: Sequence[str] = S.SEARCH_FIELDS,
) -> Column:
    """Rows whose ``field``, or any of ``fields`` if none is named, is ``location``.

    A field is searched through its stored key where ``df`` has one.
    """
    key = F.lit(normalise(location))
    predicate = F.lit(False)
    for cell in key_cells(df, fields if field is None else (field,)).values():
        predicate = predicate | (cell == key)
    return predicate


def check_columns(df: DataFrame, required: Sequence[str] = S.COLUMNS) -> DataFrame:
    """Return ``df``, or raise with the sorted names it lacks. Case counts."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"input lacks columns: {missing}")
    return df


def missing_columns(df: DataFrame, required: Sequence[str] = S.COLUMNS) -> list[str]:
    return sorted(set(required) - set(df.columns))


def check_request(
    location: str,
    field: str | None,
    offset: int,
    limit: int,
    fields: Sequence[str] = S.SEARCH_FIELDS,
) -> None:
    """Raise for a request outside the bounds. The length counts before stripping."""
    if field is not None and field not in fields:
        raise ValueError(f"field must be one of: {', '.join(fields)}")
    if not 1 <= len(location) <= S.MAX_LOCATION_LENGTH:
        raise ValueError(f"location must have 1 to {S.MAX_LOCATION_LENGTH} characters")
    if not 0 <= offset <= S.MAX_OFFSET:
        raise ValueError(f"offset must be from 0 to {S.MAX_OFFSET}")
    if not 0 <= limit <= S.MAX_LIMIT:
        raise ValueError(f"limit must be from 0 to {S.MAX_LIMIT}")


def request_error(fields: Sequence[str] = S.SEARCH_FIELDS) -> Column:
    """``check_request`` for a table of requests: the error text, else null."""
    names = ", ".join(map(sql_text, fields))
    return F.expr(
        f"""
        CASE WHEN field IS NOT NULL AND field NOT IN ({names})
               THEN {sql_text(f"field must be one of: {', '.join(fields)}")}
             WHEN location IS NULL OR length(location) NOT BETWEEN 1 AND {S.MAX_LOCATION_LENGTH}
               THEN 'location must have 1 to {S.MAX_LOCATION_LENGTH} characters'
             WHEN `offset` IS NULL OR `offset` NOT BETWEEN 0 AND {S.MAX_OFFSET}
               THEN 'offset must be from 0 to {S.MAX_OFFSET}'
             WHEN `limit` IS NULL OR `limit` NOT BETWEEN 0 AND {S.MAX_LIMIT}
               THEN 'limit must be from 0 to {S.MAX_LIMIT}' END
        """
    )
