"""Estimate Pi by seeded sampling, one independent stream per partition id."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from numberplace import schema as S

_CHUNK = 1_000_000
_POINTS_PER_ARRAY = 10_000
_MAX_TASKS = 10_000
_SEED_BITS = 32

# Executors get the functions of this module with the task, so that the package
# need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def partition_ids(spark: SparkSession, partitions: int) -> DataFrame:
    """Ids 0 to ``partitions - 1``, one per task while there are not too many."""
    if partitions <= 0:
        raise ValueError("partitions must be greater than 0")
    return spark.range(0, partitions, 1, min(partitions, _MAX_TASKS))


def stream(seed: int) -> np.random.RandomState:
    """NumPy's generator in the state of ``random.Random(seed)``.

    Python seeds with the absolute value, as 32-bit words from the lowest.
    """
    words, rest = [abs(seed) & 0xFFFFFFFF], abs(seed) >> _SEED_BITS
    while rest:
        words.append(rest & 0xFFFFFFFF)
        rest >>= _SEED_BITS
    return np.random.RandomState(words)


def inside_circle(seed: int, points: int) -> int:
    """Draw ``points`` pairs, x before y, from [-1, 1) and count those in the circle."""
    draws, inside = stream(seed), 0
    for start in range(0, points, _CHUNK):  # bounds memory, keeps the sequence
        pairs = draws.random_sample((min(_CHUNK, points - start), 2)) * 2 - 1
        inside += int(np.count_nonzero((pairs * pairs).sum(axis=1) <= 1))
    return inside


def sample_exact(
    ids: DataFrame, points: int = S.SAMPLE_POINTS, seed: int = S.SAMPLE_SEED, id_column: str = "id"
) -> DataFrame:
    """The estimate with the numbers Python's own generator gives.

    A stream is seeded by the id in the row and not by the physical partition,
    so neither the layout nor a repeated task changes the result.
    """
    _check_points(points)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"inside": [inside_circle(seed + int(i), points) for i in batch["id"]]})

    counted = ids.select(F.col(id_column).cast("bigint").alias("id")).mapInPandas(count, "inside long")
    return _estimate(counted.agg(F.count(F.lit(1)).alias("partitions"), F.sum("inside").alias("inside")), points)


def sample_native(
    ids: DataFrame, points: int = S.SAMPLE_POINTS, seed: int = S.SAMPLE_SEED, id_column: str = "id"
) -> DataFrame:
    """The estimate with Spark's own hash as the generator: no Python worker.

    Point k of partition id i is hashed from i, k and the seed, so this result
    does not depend on the layout either. Its numbers differ from ``sample_exact``.
    """
    _check_points(points)
    last_point = F.lit(points - 1).cast("bigint")
    starts = F.sequence(F.lit(0).cast("bigint"), last_point, F.lit(_POINTS_PER_ARRAY).cast("bigint"))
    of_start = F.sequence(F.col("start"), F.least(F.col("start") + (_POINTS_PER_ARRAY - 1), last_point))
    drawn = (
        ids.select(F.col(id_column).cast("bigint").alias("id"))
        .select("id", F.explode(starts).alias("start"))  # two steps, so that no
        .select("id", F.explode(of_start).alias("point"))  # array grows with points
    )
    x, y = (_uniform(_hash(seed, axis)) for axis in (0, 1))
    counted = drawn.agg(
        F.count_if(F.col("point") == 0).alias("partitions"),
        F.count_if(x * x + y * y <= 1).alias("inside"),
    )
    return _estimate(counted, points)


def _check_points(points: int) -> None:
    if points <= 0:
        raise ValueError("points must be greater than 0")


def _hash(seed: int, axis: int) -> Column:
    return F.xxhash64(F.lit(seed).cast("bigint"), F.lit(axis).cast("bigint"), "id", "point")


def _uniform(bits: Column) -> Column:
    """The upper 53 bits of a hash as a double from [-1, 1)."""
    return F.shiftrightunsigned(bits, 11).cast("double") * (2.0**-52) - 1


def _estimate(counted: DataFrame, points: int) -> DataFrame:
    pi = 4 * F.col("inside_points") / F.col("total_points")
    return (
        counted.withColumn("points_per_partition", F.lit(points).cast("bigint"))
        .withColumn("total_points", F.col("partitions") * points)
        .withColumnRenamed("inside", "inside_points")
        .withColumn("pi", pi)
        .withColumn("pi_text", F.format_string("%.8f", "pi"))
        .select("partitions", "points_per_partition", "total_points", "inside_points", "pi", "pi_text")
    )
