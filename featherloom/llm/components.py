"""Connected components of a large graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from featherloom.llm.common import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Connects the larger (or the smaller) neighbours of each node to its least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    linked = both.join(least, "a")
    if large:
        return linked.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return (linked.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
            .unionByName(least.select("a", F.col("least").alias("b"))))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b); the root is the component's least node.

    Loops are ignored. Every round halves the depth of the trees or better, and is written to the
    shared folder; only its counts reach the driver.
    """
    edges = materialise(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
                          ).first()
        if state == seen or not state[0]:
            break
        seen = state
        edges = materialise(_star(_star(edges, True).where("a <> b").distinct(), False)
                            .where("a <> b").distinct())
    rooted = edges.groupBy("a").agg(F.min("b").alias("b"))
    return rooted.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        rooted.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
