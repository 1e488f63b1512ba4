"""Connected components of an edge table by alternating star contractions.

Every round is a few aggregations and joins on node ids; no component is ever gathered in one task,
and the number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreflow.llm.common import stored


def _lowest_neighbour(edges: DataFrame) -> DataFrame:
    """node, low: the smallest of the node itself and the nodes that `edges` (node, other) gives it."""
    return edges.groupBy("node").agg(F.min("other").alias("low")).select(
        "node", F.least("node", "low").alias("low")
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
    joined = both.join(_lowest_neighbour(both), "node").where("other > node")
    return joined.select(F.col("other").alias("node"), F.col("low").alias("other")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other"))
    joined = down.join(_lowest_neighbour(down), "node")
    moved = joined.select(F.col("other").alias("node"), F.col("low").alias("other"))
    kept = joined.select("node", F.col("low").alias("other"))
    return moved.unionByName(kept).where("node <> other").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """node, component for every node of `edges` (node, other: bigint, either order, repeats allowed);
    component is the smallest node that can be reached. Loops and empty tables give no rows."""
    current = stored(edges.where("node <> other").select("node", "other").distinct(), "edges")
    before = None
    while True:
        state = current.agg(
            F.count("*"), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))
        ).head()
        if state[0] == 0 or state == before:
            break
        before = state
        current = stored(_small_star(_large_star(current)), "edges")
    return current.select("node", F.col("other").alias("component"))
