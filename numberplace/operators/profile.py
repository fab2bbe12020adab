"""What a table holds: rows, nulls and blanks per column, and whether it loads."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from numberplace import schema as S
from numberplace.functions.match import check_columns
from numberplace.session import stored
from numberplace.sources.csv_files import load_csv
from numberplace.sources.tables import read_table


def column_profile(df: DataFrame, columns: Sequence[str] = S.COLUMNS) -> DataFrame:
    """Rows, and per column its null and its blank cells, in one pass."""
    return df.agg(F.count(F.lit(1)).alias("records_loaded"), *_cell_counts(columns))


def _cell_counts(columns: Sequence[str]) -> list[Column]:
    counts = []
    for name in columns:
        counts.append(F.count_if(F.col(name).isNull()).alias(f"{name}_nulls"))
        counts.append(F.count_if(F.trim(F.col(name)) == "").alias(f"{name}_blanks"))
    return counts


def load_profile(
    spark: SparkSession,
    path: str,
    service: str,
    columns: Sequence[str] = S.COLUMNS,
    written_here: bool = False,
    table: bool = False,
) -> DataFrame:
    """The state of a CSV input, or of a Parquet ``table``, as one row, made afresh by each call.

    An input that cannot be read or lacks columns is reported, not raised: not
    ready, with the error, no rows loaded and no counts. Its one row is worked
    out here, because a file may fail only while it is read.
    """
    state = {
        "service": service,
        "ready": False,
        "master": spark.conf.get("spark.master", None),
        "data_path": path,
        "records_loaded": 0,
        "error": None,
    }
    try:
        df = check_columns(read_table(spark, path), columns) if table else load_csv(spark, path, columns, written_here)
        state |= column_profile(df, columns).first().asDict()
        state["ready"] = True
    except (PySparkException, Py4JJavaError, ValueError) as error:
        state["error"] = str(error)
    return spark.createDataFrame([state], _state_schema(columns))


def file_profile(spark: SparkSession, path: str | list[str], columns: Sequence[str] = S.COLUMNS, written_here: bool = False) -> DataFrame:
    """The state of every CSV file of an input: (file, ready, error, records_loaded, and nulls and blanks per column).

    A file is faulty if its header lacks columns, which are named, or orders them unlike the
    other files that ``columns`` are read by; it counts no rows. Headers are read as text;
    one more pass, grouped by file, profiles the files in order. An input that is
    absent is raised, as there is no file to name.
    """
    first = F.min_by("value", "place").alias("header")
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("place"), "value",
        F.col("_metadata.file_block_start").alias("block"))
    headers = lines.filter("block = 0").groupBy("file").agg(first)
    names = F.transform(F.split("header", ","), lambda x: F.btrim(x, F.lit('"\ufeff')))
    wanted = F.array(*map(F.lit, columns))
    missing = F.array_sort(F.array_except(wanted, F.col("names")))
    states = stored(headers.withColumn("names", names).withColumn("missing", missing))
    usual = states.filter("size(missing) = 0").groupBy("names").agg(F.count("*").alias("files"), F.min("file").alias("file")).orderBy(
        F.col("files").desc(), "file").first()
    error = F.when(F.size("missing") > 0, F.concat(F.lit("input lacks columns: ["), F.array_join(
        F.transform("missing", lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]")))
    if usual:
        differs = ~F.col("names").eqNullSafe(F.array(*map(F.lit, usual.names)))
        error = F.coalesce(error, F.when(differs, F.lit("columns in another order than in other files")))
    judged = stored(states.select("file", error.alias("error")))
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (usual.names if usual else columns)])
    reader = spark.read.schema(schema).option("header", True).option("encoding", "UTF-8").option("enforceSchema", True)
    rows = (reader.option("escape", '"') if written_here else reader).csv(path)
    named = rows.select(*columns, F.col("_metadata.file_path").alias("file"))
    good = named.join(F.broadcast(judged.filter("error IS NULL").select("file")), "file", "left_semi")
    counted = good.groupBy("file").agg(F.count(F.lit(1)).alias("records_loaded"), *_cell_counts(columns))
    every = ["records_loaded", *(f"{name}_{kind}" for name in columns for kind in ("nulls", "blanks"))]
    zero = [F.when(F.col("error").isNull(), F.coalesce(c, F.lit(0))).alias(c) for c in every[1:]]
    return judged.join(counted, "file", "left").select(
        "file", F.col("error").isNull().alias("ready"), "error", F.coalesce("records_loaded", F.lit(0)).alias("records_loaded"), *zero)


def _state_schema(columns: Sequence[str]) -> T.StructType:
    schema = (
        T.StructType()
        .add("service", "string")
        .add("ready", "boolean")
        .add("master", "string")
        .add("data_path", "string")
        .add("records_loaded", "long")
        .add("error", "string")
    )
    for name in columns:
        schema = schema.add(f"{name}_nulls", "long").add(f"{name}_blanks", "long")
    return schema
