"""Connected components by alternating large and small stars.

Each round hangs the neighbours of every node below their smallest neighbour, first the
larger ones and then the smaller ones, until the edges are stars around the smallest node
of each component. Each step is a grouping that is pre-aggregated and a join; nothing is
gathered per node, so a node with very many edges is no task's own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainlane.staging import stage


def connected(edges: DataFrame) -> DataFrame:
    """Columns node and root, the smallest node of its component, for each node of ``edges``
    (a, b: long) that is not a root itself. Loops and repeated edges do no harm."""
    ordered = edges.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
    now = stage(ordered.where("high > low").distinct(), "edges")
    sign = _signature(now)
    while True:
        now = stage(_small_star(_large_star(now)), "edges")
        before, sign = sign, _signature(now)
        if sign == before:
            return now.select(F.col("high").alias("node"), F.col("low").alias("root"))


def _signature(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("high", "low")), F.sum("low")).first()


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node go below the smallest of the node and its neighbours."""
    above = edges.groupBy("high").agg(F.min("low").alias("least"))
    up = edges.select("high", F.col("low").alias("node")).join(
        above.select(F.col("high").alias("node"), "least"), "node", "left"
    )
    return up.select("high", F.coalesce("least", "node").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, go below the smallest of them."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    down = edges.join(least, "high").where("low > least").select(F.col("low").alias("high"), "least")
    return down.unionByName(least).select("high", F.col("least").alias("low")).distinct()
