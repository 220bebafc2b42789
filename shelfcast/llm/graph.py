"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
    ).first()
    return tuple(row)


def _large(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    ).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), "m")
    kept = least.select("u", "m")
    return moved.unionByName(kept).withColumnRenamed("m", "v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the least node reachable, for every node that has a link.

    No group is gathered: each round is a minimum per node (summed inside tasks first)
    and an equi-join, so a node with very many links is only many rows. Rounds grow with
    the logarithm of the longest chain. An empty table gives an empty table.
    """
    edges = stored(
        links.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    before = _mark(edges)
    while before[0]:
        edges = stored(_small(_large(edges)))
        now = _mark(edges)
        if now == before:
            break
        before = now
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)
