"""Session helpers: a local session for tests, and the shared scratch folder."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession

#: Of its limit, what the driver's heap may take before a stored or deleted table has it collected.
HEAP_SHARE = 0.4
_CHECKPOINT_DIR = "spark.checkpoint.dir"
# Names of the folders of open ``scratch`` calls, innermost last.
_owned: list[str] = []


def local_session(cores: int | str = 8, app_name: str = "numberplace") -> SparkSession:
    """A session for tests and benches on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        # Spares a Python stack walk for each column expression that is built.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def scratch_path(spark: SparkSession) -> str:
    """A fresh path in the folder that ``spark.checkpoint.dir`` names.

    On a cluster that folder has to be shared, so it is never guessed there. A
    local session may go without the setting and then gets a temporary folder.
    """
    root = spark.conf.get(_CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that every executor reaches")
        root = tempfile.mkdtemp(prefix="numberplace-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(root)
    return "/".join([root.rstrip("/"), *_owned[-1:], uuid.uuid4().hex])


@contextmanager
def scratch_folder(spark: SparkSession) -> Iterator[str]:
    """Let calls inside write to a folder of their own, whose path is given; ``delete_scratch`` deletes it."""
    name = f"call-{uuid.uuid4().hex}"
    _owned.append(name)
    try:
        yield scratch_path(spark).rpartition("/")[0]
    finally:
        _owned.remove(name)


def delete_scratch(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release_memory(spark: SparkSession, above: float = 0.0) -> None:
    """Let the driver give back what it no longer uses, in Python and in the JVM.

    Plans and broadcasts without a user are collected, on which Spark deletes the
    shuffles and blocks that belong to them, and an emptied heap shrinks. Nothing
    is done while the heap takes less than the share ``above`` of its limit.
    """
    runtime = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    if runtime.totalMemory() < above * runtime.maxMemory():
        return
    gc.collect()
    pa.default_memory_pool().release_unused()
    spark.sparkContext._jvm.java.lang.System.gc()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what calls inside have written to the scratch folder.

    Results that such calls return read from there: use or write them before.
    """
    with scratch_folder(spark) as folder:
        try:
            yield
        finally:
            delete_scratch(spark, folder)


def stored(df: DataFrame, **measures: Column) -> DataFrame | tuple[DataFrame, dict]:
    """Write ``df`` once to the shared folder and read it back.

    Later passes read the files, so a lost executor costs no recomputation and
    every pass sees the same rows. Unlike a cache it holds no executor memory.
    With ``measures``, aggregates of ``df``, their values come along; they are
    taken while it is written. If the driver's heap has grown, what the plan took
    there is collected.
    """
    path, measured = scratch_path(df.sparkSession), Observation()
    if measures:
        df = df.observe(measured, *(value.alias(name) for name, value in measures.items()))
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    release_memory(df.sparkSession, HEAP_SHARE)
    return (back, measured.get) if measures else back


def discard(df: DataFrame) -> None:
    """Delete the files of a ``stored`` table, which nothing may read from then on.

    If the driver's heap has grown, what the plans behind it took there goes, too.
    """
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        delete_scratch(df.sparkSession, folder)
    release_memory(df.sparkSession, HEAP_SHARE)
