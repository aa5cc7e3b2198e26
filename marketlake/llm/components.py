"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.session import materialize


def _smallest(links: DataFrame) -> DataFrame:
    """(u, m), written, so that a join with it deals out the links of a very common node."""
    found = links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return materialize(found, "smallest")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest one."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    return both.join(_smallest(both), "u").filter(F.col("v") > F.col("u")).select(
        F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest one."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    lowest = _smallest(down)
    links = down.join(lowest, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return links.unionByName(lowest.select(F.col("u").alias("a"), F.col("m").alias("b")))


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from every node of ``edges`` (a, b).

    Each round is written to the shared folder, so lineage stays short and a lost
    executor costs one round.  A node shared by many edges is a hot join key on one side
    only, which adaptive execution splits; grouping combines before the shuffle.  The
    number of rounds grows with the logarithm of the longest chain.
    """
    edges = materialize(edges.filter("a <> b").distinct(), "edges")
    before = None
    while True:
        edges = materialize(
            _small_star(_large_star(edges)).filter("a <> b").distinct(), "star")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    # Fixed point: every edge leads from a node to its root.
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
