"""Deterministic records: one per index, computed from the index alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from numberplace import schema as S
from numberplace.functions.match import sql_text


def places_table(spark: SparkSession, places: Sequence[tuple] = S.PLACES) -> DataFrame:
    """The place list with its positions ``k``, as constant rows of the plan."""
    rows = ", ".join(f"({k}, {', '.join(map(sql_text, place))})" for k, place in enumerate(places))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS places (k, {', '.join(S.SEARCH_FIELDS)})")


def records_from(df: DataFrame, index: str, places: Sequence[tuple] = S.PLACES) -> DataFrame:
    """Turn each row of ``df`` into the record of its ``index`` (0, 1, 2, ...).

    ``index`` is a column or an expression. Two of five indexes fall on place 0,
    the rest spread over the others. The place list is a handful of constants
    and is broadcast whatever ``df`` is; a filter on place columns is worked out
    on the list and not per row. The base of the phone numbers has ten digits
    already, so they need no zero padding.
    """
    places_df = places_table(df.sparkSession, places)
    return (
        df.selectExpr(f"CAST({index} AS bigint) AS i")
        .selectExpr("i", f"IF(i % 5 < 2, 0, CAST(1 + i * 17 % {len(places) - 1} AS int)) AS k")
        .join(F.broadcast(places_df), "k")
        .selectExpr(
            f"CAST({S.FIRST_RECORD_ID} + i AS string) AS record_id",
            f"IF(i = 0, '{S.FIRST_PHONE_NUMBER}', concat('1', CAST({S.PHONE_BASE} + i AS string))) AS phone_number",
            *S.SEARCH_FIELDS,
        )
    )


def generate(spark: SparkSession, rows: int, partitions: int | None = None) -> DataFrame:
    """The record table of ``rows`` rows, as a plan over ``spark.range``."""
    if rows <= 0:
        raise ValueError("the number of rows must be greater than 0")
    return records_from(spark.range(0, rows, 1, partitions), "id")
