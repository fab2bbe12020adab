"""Exact row numbers without putting a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from numberplace.session import stored

START = "start_position"
COPIES = "copies"

_SEQUENCE = "_sequence"
_PART = "_part"


def number_rows(
    rows: DataFrame, group: Sequence[str], order: Sequence[Column], ranges: Sequence[Column] | None = None
) -> DataFrame:
    """Number ``rows`` from 0 within ``group`` by ``order``, identical rows merged.

    Adds ``start_position``, the number of the first copy of the row, and
    ``copies``. A window over ``group`` would sort all of a hot group in one
    task. Here the rows are range-partitioned by group *and* order, so a hot
    group spreads over many tasks, and the counts per (group, partition), a
    small table, give each partition its starting number. Merging copies first
    leaves no two rows with the same sort key, hence no range that cannot be
    split; the merge is combined on the map side.

    ``group`` columns hold no nulls; ``order`` only ties on identical rows. ``ranges`` are
    narrower columns that agree with it: a range partitioning samples its keys to the
    driver, so they should not hold whole rows. The ranged rows are stored once, because
    both later steps have to see the same partitions.
    """
    merged = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(COPIES))
    groups = [F.col(c).asc_nulls_last() for c in group]
    ranged = stored(
        merged.repartitionByRange(*groups, *(ranges or order))
        .sortWithinPartitions(*groups, *order)
        .withColumn(_SEQUENCE, F.monotonically_increasing_id())
    ).withColumn(_PART, F.shiftright(_SEQUENCE, 33))  # the partition half of the id

    by_part = [*group, _PART]
    earlier = Window.partitionBy(*group).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(*by_part)
        .agg(F.sum(COPIES).alias("n"))
        .select(*by_part, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    )
    within = (
        Window.partitionBy(*by_part).orderBy(_SEQUENCE).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        ranged.withColumn("_within", F.coalesce(F.sum(COPIES).over(within), F.lit(0)))
        .join(starts, by_part)
        .withColumn(START, F.col("_before") + F.col("_within"))
        .select(*rows.columns, START, COPIES)
    )


def cut(numbered: DataFrame, first: Column, last: Column, position: str | None = None) -> DataFrame:
    """The rows at positions ``first`` <= p < ``last``, copies written out again.

    ``first`` and ``last`` are columns or constants; ``position`` names the
    output column for p, if wanted.
    """
    low = F.greatest(F.col(START), first)
    high = F.least(F.col(START) + F.col(COPIES), last)
    out = [c for c in numbered.columns if c not in (START, COPIES)]
    name = position or "_position"
    expanded = numbered.filter(low < high).withColumn(name, F.explode(F.sequence(low, high - 1)))
    return expanded.select(*out, *([name] if position else []))

