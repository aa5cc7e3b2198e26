"""Facet counts and per-filter totals."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def facet_counts(df: DataFrame, facets: dict[str, Column],
                 lists: dict[str, Column] | None = None) -> DataFrame:
    """(facet, value, found) for several dimensions in one pass.

    Each row expands to one (facet, value) pair per dimension, and one per element
    for list dimensions; counts are combined inside each task, so the shuffle
    carries one row per distinct pair and task.  NULL values are counted too; an
    empty list counts for nothing.
    """
    def pair(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("facet"), value.cast("string").alias("value"))

    pairs = F.array(*[pair(name, value) for name, value in facets.items()])
    for name, items in (lists or {}).items():
        of_list = F.transform(items, partial(pair, name))
        pairs = F.concat(pairs, F.coalesce(of_list, F.array(pair(name, F.lit(None)))))
    return (
        df.select(F.explode(pairs).alias("p"))
        .groupBy(F.col("p.facet").alias("facet"), F.col("p.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("found"))
    )


def filter_overlap(df: DataFrame, values: Column, key: str) -> DataFrame:
    """Per filter value: rows found and distinct keys (values may be multi-valued)."""
    return (
        df.select(F.explode(values).alias("filter_value"), key)
        .groupBy("filter_value", key)
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("filter_value")
        .agg(F.sum("n").alias("total_cnt"), F.count(key).alias("unique_cnt"))
    )
