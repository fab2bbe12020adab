"""Connected components of a link table, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from numberplace.session import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (u, v); the component is its smallest node.

    Each round lets every node hand its smallest neighbour to the others, first
    to the greater ones, then to the rest. A node with very many links is read
    as rows of a join that Spark may split, never as one list.
    """
    edges = stored(_ordered(links))
    while True:
        large = stored(_star(_both(edges), greater_only=True))
        small = stored(_star(large, greater_only=False), n=F.count("*"), check=F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")))
        before = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("check")).first()
        edges, measured = small
        if (before.n, before.check) == (measured["n"], measured["check"]):
            break
    tops = edges.groupBy("u").agg(F.min("v").alias("v"))
    roots = edges.select(F.col("v").alias("u")).distinct().join(tops.select("u"), "u", "left_anti")
    return tops.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select(F.col("u").alias("node"), F.col("u").alias("component")))


def _ordered(links: DataFrame) -> DataFrame:
    """Each link once, from the greater to the smaller node."""
    return links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(edges: DataFrame, greater_only: bool) -> DataFrame:
    """Link the neighbours of each node (the greater ones; or all of them and the node) to the least of them all."""
    least = stored(edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least")))
    if greater_only:
        moved = edges.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    else:
        moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
            least.select("u", F.col("least").alias("v")))
    return moved.filter("u <> v").distinct()
