"""Values sent once to every executor."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import SparkSession


def shared(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast ``value`` and return what gives it back in a task.

    Only for values of a proven size. Their classes travel along, which a plain
    broadcast would expect the executors to know.
    """
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(sent.value)
