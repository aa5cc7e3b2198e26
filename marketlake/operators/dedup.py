"""De-duplication and repeated-key operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.joins import HOT_ROWS, join_group_sizes, join_null_safe

ROW_NUMBER = "_rn"


def row_hash(df: DataFrame) -> Column:
    """Order-stable hash of all columns, a tie-break that does not depend on file order."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def keep_latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order`` (which should be a total order).

    Spark keeps the best row per key inside each input task before it shuffles
    (WindowGroupLimit), so a key with very many copies sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(ROW_NUMBER, F.row_number().over(window))
        .filter(F.col(ROW_NUMBER) == 1)
        .drop(ROW_NUMBER)
    )


def keep_any(df: DataFrame, keys: list[str]) -> DataFrame:
    """One arbitrary row per key."""
    return df.dropDuplicates(keys)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, cnt) of keys that occur more than once; NULL keys form one group."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)
    )


def repeated_rows(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """All rows whose key occurs more than once.

    Keys are counted first (partial counts leave each task) and joined back, hot keys
    by broadcast; a window over the key would put all copies of it in one task.
    """
    return join_group_sizes(df, repeated_keys(df, keys), keys, "cnt", hot_rows).drop("cnt")


def publication_counts(df: DataFrame, key: str, day: Column) -> DataFrame:
    """Per key: number of rows, number of days, first and last day."""
    return (
        df.withColumn("_day", day)
        .groupBy(key, "_day")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(key)
        .agg(
            F.sum("n").alias("publication_cnt"),
            F.count("_day").alias("day_cnt"),
            F.min("_day").alias("first_day"),
            F.max("_day").alias("last_day"),
        )
    )


def with_publication_count(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add how many rows share the key, as a column on every row."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("publication_cnt"))
    return join_group_sizes(df, counts, [key], "publication_cnt", hot_rows)


def most_repeated_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """The key with the most rows (smallest key on a tie), one row."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.col("cnt").desc(), *keys)
        .limit(1)
    )


def distinct_rows_of_top_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """For the most repeated key: its rows and how many of them differ.

    One row is broadcast (the top key), and only distinct copies are shuffled.
    """
    top = most_repeated_key(df, keys)
    rows = join_null_safe(df, F.broadcast(top), keys)
    return (
        rows.groupBy(*df.columns)
        .agg(F.first("cnt").alias("cnt"))
        .groupBy(*keys)
        .agg(F.first("cnt").alias("row_cnt"), F.count(F.lit(1)).alias("distinct_row_cnt"))
    )


def duplicate_share(df: DataFrame, key: str, by: list[str]) -> DataFrame:
    """Per group: non-null keys, distinct keys, share of repeats in percent."""
    per_key = (
        df.filter(F.col(key).isNotNull()).groupBy(*by, key).agg(F.count(F.lit(1)).alias("n"))
    )
    total = F.sum("n")
    unique = F.count(F.lit(1))
    return per_key.groupBy(*by).agg(
        total.alias("total_id_cnt"),
        unique.alias("unique_id_cnt"),
        F.round((total - unique) / total * 100, 2).alias("share_of_duplicates_pcnt"),
    )
