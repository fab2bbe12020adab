"""Counts: one exact pair, all places at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from numberplace import schema as S
from numberplace.functions.match import pair_predicate


def pair_count(
    df: DataFrame,
    province: str = S.DEFAULT_PROVINCE,
    city: str = S.DEFAULT_CITY,
    columns: tuple[str, str] = ("province", "city"),
) -> DataFrame:
    """Matching and scanned rows of one pair: one pass that reads two columns."""
    counted = df.agg(
        F.count_if(pair_predicate(province, city, columns)).alias("match_count"),
        F.count(F.lit(1)).alias("records_scanned"),
    )
    return counted.select(
        F.lit(province).alias("province"), F.lit(city).alias("city"), "match_count", "records_scanned"
    )


def place_counts(df: DataFrame, columns: Sequence[str] = ("province", "city")) -> DataFrame:
    """``pair_count`` for every combination of values, in one pass.

    Partial counts are combined before the shuffle, so a combination that holds
    a large part of the table sends one row per task.
    """
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
