"""Joins that treat NULL keys as equal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str],
                   how: str = "inner", never_null: tuple[str, ...] = ()) -> DataFrame:
    """Join on ``keys`` without losing rows whose key is NULL; key columns come from left.

    Spark turns null-safe equality into ordinary hash or sort-merge keys, two for each
    column; columns in ``never_null`` are joined by plain equality, with one.
    """
    both = [*keys, *never_null]
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in both})
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    same += [F.col(k) == F.col(f"_right_{k}") for k in never_null]
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in both])


# Groups with more rows than this are told from the others.  There are at most
# (all rows / HOT_ROWS) of them; Spark broadcasts them while that table is small by its
# size check, and otherwise splits their rows between tasks (adaptive skew join).
HOT_ROWS = 1_000_000


def split_hot(df: DataFrame, sizes: DataFrame, keys: list[str], size: str,
              hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(rows of hot groups, all other rows).

    ``sizes`` holds one row per group with its number of rows in ``size``.
    """
    hot = sizes.filter(F.col(size) > hot_rows).select(*keys)
    return (
        join_null_safe(df, hot, keys, "left_semi"),
        join_null_safe(df, hot, keys, "left_anti"),
    )


def join_group_sizes(df: DataFrame, sizes: DataFrame, keys: list[str], size: str,
                     hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows with the columns of their group in ``sizes``, for groups of any size.

    Hot groups meet their few rows of ``sizes`` apart from the others, which take an
    ordinary join in which no key is frequent.
    """
    hot = sizes.filter(F.col(size) > hot_rows)
    rest = sizes.filter(F.col(size) <= hot_rows)
    _, other_rows = split_hot(df, sizes, keys, size, hot_rows)
    return join_null_safe(df, hot, keys).unionByName(
        join_null_safe(other_rows, rest, keys)
    )


def look_up(df: DataFrame, dictionary: DataFrame, key: str, dictionary_key: str) -> DataFrame:
    """Add the columns of a dictionary table; Spark broadcasts it when it is small."""
    return df.join(dictionary.withColumnRenamed(dictionary_key, key), key, "left")


def keep_members(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the member set."""
    return df.join(members.select(key), key, "left_semi")
