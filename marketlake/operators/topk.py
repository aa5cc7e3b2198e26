"""Top-k groups, first-n per group and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_groups(df: DataFrame, keys: list[str], k: int, ties: list[Column] | None = None,
               name: str = "cnt") -> DataFrame:
    """The k largest groups by row count; ``ties`` gives the order of equal counts."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.col(name).desc(), *(ties or [F.col(k_) for k_ in keys]))
        .limit(k)
    )


def first_n_per_group(df: DataFrame, keys: list[str], n: int, order: list[Column],
                      spread_by: Column, salts: int = 1024) -> DataFrame:
    """The first n rows of every group, exact, with a hot group spread over tasks.

    A row among the first n of its group is also among the first n of its salt
    share, so ranking inside (group, salt) first leaves at most ``salts * n`` rows
    of any group for the final ranking.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)))
    for part in ([*keys, "_salt"], keys):
        window = Window.partitionBy(*part).orderBy(*order)
        salted = (
            salted.withColumn("_rn", F.row_number().over(window))
            .filter(F.col("_rn") <= n)
            .drop("_rn")
        )
    return salted.drop("_salt")


def top_values_per_group(df: DataFrame, group: str, value: str, k: int) -> DataFrame:
    """The k most frequent values in every group: (group, value, cnt, rank)."""
    counts = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("cnt"))
    window = Window.partitionBy(group).orderBy(F.col("cnt").desc(), F.col(value))
    return counts.withColumn("rank", F.row_number().over(window).cast("bigint")).filter(
        F.col("rank") <= k
    )


def random_rows(df: DataFrame, n: int, seed: int) -> DataFrame:
    """n random rows; one shuffle-free top-n pass instead of a full sort."""
    return df.withColumn("_r", F.rand(seed)).orderBy("_r").limit(n).drop("_r")


def stable_sample(df: DataFrame, n: int, key: Column) -> DataFrame:
    """n rows picked by hashed key: the same rows on every run and cluster size."""
    return df.withColumn("_h", F.md5(key.cast("string"))).orderBy("_h").limit(n).drop("_h")


def tail(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The last n rows in a stated order (file order is not stable on a cluster)."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)
