"""CSV in and out: a header row, every column text, UTF-8."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from numberplace import schema as S
from numberplace.functions.match import check_columns


def read_csv(spark: SparkSession, path: str | list[str], written_here: bool = False) -> DataFrame:
    """Read CSV with the names of its header and all columns as strings.

    Each file's own header is compared with the names in use: in a folder whose
    files order their columns differently, Spark would otherwise go by position.
    ``written_here`` reads the doubled quotes of ``write_csv``.
    """
    reader = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("encoding", "UTF-8")
        .option("enforceSchema", False)
    )
    if written_here:
        reader = reader.option("escape", '"')
    return reader.csv(path)


def load_csv(
    spark: SparkSession,
    path: str | list[str],
    required: Sequence[str] = S.COLUMNS,
    written_here: bool = False,
) -> DataFrame:
    """``read_csv`` with the check that the ``required`` columns are there."""
    return check_columns(read_csv(spark, path, written_here), required)


def write_csv(df: DataFrame, path: str) -> int:
    """Write ``df`` as a folder of CSV files and return the number of rows.

    The rows are counted while they are written. Blanks at the ends of a cell
    are kept and quotes are doubled. Null and the empty text both come back as
    null.
    """
    written = Observation()
    (
        df.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return written.get["rows"]
