"""Area tree: parent/child table walks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.session import materialize


def walk_tree(nodes: DataFrame, sep: str = " / ") -> DataFrame:
    """(id, parent_id, name, level, path) of every node under the roots, however deep.

    ``nodes`` holds (id, parent_id, name); roots have a NULL parent.  Each level is one
    join on the parent key with the level above, which is written, and the walk ends at
    the first level without nodes.  Nodes that no root leads to are not returned.
    """
    nodes = materialize(nodes.select("id", "parent_id", "name"), "tree")
    level = materialize(nodes.filter(F.col("parent_id").isNull()).select(
        "id", "parent_id", "name", F.lit(0).cast("bigint").alias("level"),
        F.col("name").alias("path"),
    ), "tree")
    levels = [level]
    while not level.isEmpty():
        up = level.select(F.col("id").alias("parent_id"), "level", F.col("path").alias("up_path"))
        level = materialize(nodes.join(up, "parent_id").select(
            "id", "parent_id", "name", (F.col("level") + 1).alias("level"),
            F.concat("up_path", F.lit(sep), "name").alias("path"),
        ), "tree")
        levels.append(level)
    return reduce(DataFrame.unionAll, levels)


def child_counts(nodes: DataFrame) -> DataFrame:
    """(id, name, child_cnt) for every node, zero for leaves."""
    children = (
        nodes.filter(F.col("parent_id").isNotNull())
        .groupBy(F.col("parent_id").alias("id"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return nodes.join(children, "id", "left").select(
        "id", "name", F.coalesce("n", F.lit(0)).cast("bigint").alias("child_cnt")
    )


def flatten_children(nested: DataFrame, children: str) -> DataFrame:
    """Rows of (parent_id, parent_name, id, name) from records with a child list."""
    return nested.select(
        F.col("id").alias("parent_id"), F.col("name").alias("parent_name"),
        F.explode(children).alias("child"),
    ).select("parent_id", "parent_name", "child.id", "child.name")
