"""Record tables kept as Parquet, laid out for look-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from numberplace import schema as S
from numberplace.functions.match import key_column, with_keys


#: Different keys that a row group's Bloom filter is made for; some 60 kB each at 1 % of errors.
BLOOM_VALUES = 50_000


def write_table(
    df: DataFrame,
    path: str,
    fields: Sequence[str] = S.SEARCH_FIELDS,
    record_id: str | None = "record_id",
    rows_per_file: int = 5_000_000,
) -> int:
    """Store ``df`` with its keys and return the number of rows.

    Each task sorts its own rows by key before it writes them: equal keys of the
    first field then share few row groups, and a search skips the others by their
    statistics. Every key column has a Bloom filter per row group, so a search on
    another field skips those without its key as well. That takes no shuffle, so a
    frequent key stays spread over all files.
    """
    written = Observation()
    writer = (
        with_keys(df, fields, record_id)
        .sortWithinPartitions(*(key_column(field) for field in fields))
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
    )
    for field in fields:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key_column(field)}", True)
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{key_column(field)}", BLOOM_VALUES)
    writer.parquet(path)
    return written.get["rows"]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def cached(df: DataFrame) -> tuple[DataFrame, int]:
    """Keep a table that is queried repeatedly, and count it while loading it.

    For tables that fit the memory and disk of the executors; ``write_table``
    serves the others. The caller unpersists.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    return kept, kept.count()
