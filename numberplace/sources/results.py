"""One-row results as JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def completed_at_utc() -> Column:
    """The current time as ISO-8601 text in UTC, whatever the session's zone."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def write_result(df: DataFrame, path: str, append: bool = False) -> None:
    """Write a result, null fields included; ``append`` keeps earlier ones."""
    mode = "append" if append else "overwrite"
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def read_result(spark: SparkSession, path: str, schema: StructType, indented: bool = False) -> DataFrame:
    """Read results; ``indented`` for files that hold one object over several lines."""
    return spark.read.schema(schema).option("multiLine", indented).json(path)


def latest(results: DataFrame) -> DataFrame:
    """The result that was completed last; of equal times, the greatest row."""
    row = F.max_by(F.struct("*"), F.struct(F.col("completed_at_utc").cast("timestamp"), F.struct("*"))).alias("row")
    return results.agg(row).filter(F.col("row").isNotNull()).select("row.*")
