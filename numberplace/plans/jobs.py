"""The batch jobs: count a pair, sample, report on both."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from numberplace import schema as S
from numberplace.operators.counts import pair_count
from numberplace.operators.sampling import partition_ids, sample_exact
from numberplace.sources.csv_files import load_csv
from numberplace.sources.results import completed_at_utc, latest, read_result, write_result


def pair_result(counted: DataFrame, source: str) -> DataFrame:
    """A ``pair_count`` row in the form in which it is stored."""
    return counted.select(
        "province",
        "city",
        F.col("match_count").alias("count"),
        "records_scanned",
        F.lit(source).alias("input"),
        F.lit(_master(counted.sparkSession)).alias("master"),
        completed_at_utc().alias("completed_at_utc"),
    )


def sample_result(sampled: DataFrame, application: str, seed: int) -> DataFrame:
    """A sampling row in the form in which it is stored."""
    return sampled.select(
        F.lit(application).alias("application"),
        "partitions",
        "points_per_partition",
        "total_points",
        "inside_points",
        "pi",
        F.lit(seed).cast("bigint").alias("seed"),
        F.lit(_master(sampled.sparkSession)).alias("master"),
        completed_at_utc().alias("completed_at_utc"),
    )


def run_pair_count(
    spark: SparkSession,
    source: str,
    output: str,
    province: str = S.DEFAULT_PROVINCE,
    city: str = S.DEFAULT_CITY,
    append: bool = False,
    written_here: bool = False,
) -> DataFrame:
    """Count a pair in a CSV input, store the result, return the latest one."""
    counted = pair_count(load_csv(spark, source, written_here=written_here), province, city)
    write_result(pair_result(counted, source), output, append)
    return latest(read_result(spark, output, S.PAIR_RESULT_SCHEMA))


def run_sampling(
    spark: SparkSession,
    output: str,
    application: str,
    partitions: int = S.SAMPLE_PARTITIONS,
    points: int = S.SAMPLE_POINTS,
    seed: int = S.SAMPLE_SEED,
    append: bool = False,
) -> DataFrame:
    """Estimate Pi, store the result, return the latest one."""
    sampled = sample_exact(partition_ids(spark, partitions), points, seed)
    write_result(sample_result(sampled, application, seed), output, append)
    return latest(read_result(spark, output, S.SAMPLE_RESULT_SCHEMA))


def run_report(spark: SparkSession, pair_path: str, sample_path: str) -> DataFrame:
    """The latest count beside the latest sampling, numbers also as display text."""
    pair = latest(read_result(spark, pair_path, S.PAIR_RESULT_SCHEMA))
    sample = latest(read_result(spark, sample_path, S.SAMPLE_RESULT_SCHEMA))
    return report(pair, sample)


def report(pair: DataFrame, sample: DataFrame) -> DataFrame:
    """One count row beside one sampling row. Of several rows, the latest is reported."""
    left = latest(pair).select(F.lit(1).alias("_one"), F.struct("*").alias("pair_count"))
    right = latest(sample).select(F.lit(1).alias("_one"), F.struct("*").alias("sampling"))
    return left.join(right, "_one", "full").select(
        F.format_string("%.8f", F.col("sampling.pi")).alias("pi_text"),
        F.format_number("sampling.total_points", 0).alias("total_points_text"),
        F.format_number("pair_count.count", 0).alias("match_count_text"),
        "pair_count",
        "sampling",
    )


def result_lines(result: DataFrame, path: str | None = None) -> DataFrame:
    """A stored result row as ``NAME=value`` lines, as a job prints them, with the ``path`` it is stored at."""
    lines = {
        "count": "MATCH_COUNT=%d",
        "records_scanned": "RECORDS_SCANNED=%d",
        "pi": "PI_RESULT=%.8f",
        "total_points": "POINTS=%d",
        "inside_points": "INSIDE=%d",
        "partitions": "PARTITIONS=%d",
    }
    texts = [F.format_string(form, F.col(name)) for name, form in lines.items() if name in result.columns]
    if path is not None:
        texts.append(F.lit(f"RESULT_FILE={path}"))
    return result.select(F.explode(F.array(*texts)).alias("line"))


def _master(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.master", None)
