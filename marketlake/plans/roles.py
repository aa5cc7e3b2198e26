"""Open-set roles: a vote of the nearest labelled rows, or no role at all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def vote(neighbours: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """(query, voted, votes, voters, similarity): the label most neighbours have.

    Of labels with equal votes the smallest wins; ``similarity`` is that of the nearest
    neighbour, rounded to 4 decimals.  ``labels`` holds one row a key.
    """
    named = neighbours.join(labels.select(F.col(key).alias("neighbour"), F.col(label).alias("voted")), "neighbour")
    counts = named.filter("voted is not null").groupBy("query", "voted").agg(
        F.count(F.lit(1)).alias("votes"), F.max("similarity").alias("near"))
    best = counts.groupBy("query").agg(
        F.min(F.struct((-F.col("votes")).alias("order"), "voted", "votes")).alias("best"),
        F.sum("votes").alias("voters"), F.round(F.max("near"), 4).alias("similarity"))
    return best.select("query", F.col("best.voted").alias("voted"), F.col("best.votes").alias("votes"), "voters",
                       "similarity")


def threshold(voted: DataFrame, labels: DataFrame, key: str, label: str, precision: float) -> DataFrame:
    """One row (least_similarity): the least one from which on ``precision`` of the votes are right.

    ``voted`` are held-out rows whose label is known; null if no similarity is high enough.
    The votes are counted by similarity, of which there are 20 001 at most.
    """
    own = labels.select(F.col(key).alias("query"), F.col(label).alias("own"))
    steps = voted.join(own, "query").groupBy("similarity").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("own") == F.col("voted")).alias("right"))
    above = Window.orderBy(F.desc("similarity"))
    sums = steps.select("similarity", F.sum("n").over(above).alias("n"), F.sum("right").over(above).alias("right"))
    return sums.filter(F.col("right") >= F.lit(precision) * F.col("n")).agg(
        F.min("similarity").alias("least_similarity"))


def with_role(voted: DataFrame, least: DataFrame) -> DataFrame:
    """Add ``role``: the voted label, or null (unknown) below the threshold of the one row of ``least``."""
    kept = voted.crossJoin(F.broadcast(least))
    return kept.withColumn("role", F.when(F.col("similarity") >= F.col("least_similarity"), F.col("voted")))


def report(roles: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """(row_cnt, unknown_cnt, right_cnt, wrong_cnt, voted_right_cnt) of rows whose label is known."""
    own = labels.select(F.col(key).alias("query"), F.col(label).alias("own")).filter("own is not null")
    known = roles.join(own, "query")
    return known.agg(
        F.count(F.lit(1)).alias("row_cnt"), F.count_if(F.col("role").isNull()).alias("unknown_cnt"),
        F.count_if(F.col("role") == F.col("own")).alias("right_cnt"),
        F.count_if(F.col("role") != F.col("own")).alias("wrong_cnt"),
        F.count_if(F.col("voted") == F.col("own")).alias("voted_right_cnt"))
