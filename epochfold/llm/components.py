"""Connected components of a graph given by its links, by repeated star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epochfold.llm.shared import stored


def _unordered(links: DataFrame) -> DataFrame:
    """Links as (u, v) with u > v, each once."""
    ends = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    return ends.where("u > v").distinct()


def _mark(links: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    sums = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(links.agg(F.count(F.lit(1)), sums).first())


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for every node of a link (a, b); a component is its smallest node.

    Nodes are of any type with an order. Each round points every larger neighbour of a node to the
    node's smallest neighbour, and then every smaller one (large-star and small-star); it ends when
    each component is a star around its smallest node, after a number of rounds that grows with the
    logarithm of the longest path. Minima are combined on the map side, so the centre of a star is
    one row a task. Every round is written to the shared folder, so no lineage builds up. Null ends
    and links of a node to itself are ignored.
    """
    now = stored(_unordered(links), "links")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low"))
        near = both.where("v > u").join(low.select("u", F.least("low", "u").alias("low")), "u")
        large = near.select(F.col("v").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        near = large.join(low, "a")
        small = near.select("a", F.col("low").alias("b")).unionByName(
            near.select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        now, before = stored(_unordered(small), "links"), mark
        mark = _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
