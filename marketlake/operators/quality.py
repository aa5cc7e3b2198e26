"""Schema drift, layer reconciliation and batch metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def line_keys(lines: DataFrame) -> DataFrame:
    """One row per line and top-level key of raw JSON lines (broken lines have none)."""
    keys = F.explode(F.array_distinct(F.json_object_keys("value")))
    return lines.withColumn("column", keys).drop("value")


def contract_names(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared column names as a frame."""
    spark = df.sparkSession
    return spark.range(1).select(
        F.explode(F.array(*[F.lit(n) for n in schema.fieldNames()])).alias("column")
    )


def drift_report(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """(column, status, line_cnt): new, missing or known against the contract.

    Every line is read, none are sampled.
    """
    return drift_of_keys(line_keys(lines), schema)


def drift_of_keys(keys: DataFrame, schema: T.StructType) -> DataFrame:
    """The same report from a frame with a row per line and key, in ``column``."""
    seen = keys.groupBy("column").agg(F.count(F.lit(1)).alias("line_cnt"))
    declared = contract_names(keys, schema).withColumn("_declared", F.lit(True))
    return seen.join(declared, "column", "full_outer").select(
        "column",
        F.when(F.col("_declared").isNull(), "new")
        .when(F.col("line_cnt").isNull(), "missing")
        .otherwise("known").alias("status"),
        F.coalesce("line_cnt", F.lit(0)).cast("bigint").alias("line_cnt"),
    )


def columns_per_file(lines: DataFrame) -> DataFrame:
    """(file_path, column) pairs that occur."""
    return line_keys(lines).select("file_path", "column").distinct()


def column_counts(lines: DataFrame) -> DataFrame:
    """(file_path, column_cnt)."""
    return columns_per_file(lines).groupBy("file_path").agg(
        F.count(F.lit(1)).alias("column_cnt")
    )


def missing_columns(lines: DataFrame) -> DataFrame:
    """(file_path, column) for columns some file has and this file lacks.

    Works on one name set per file; the list of all names is a scalar subquery.
    """
    pairs = columns_per_file(lines)
    per_file = pairs.groupBy("file_path").agg(F.collect_set("column").alias("have"))
    every = pairs.select("column").distinct().agg(F.collect_list("column")).scalar()
    return per_file.select(
        "file_path", F.explode(F.array_except(every, F.col("have"))).alias("column")
    )


def name_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """(column, only_in) of names found on one side only; both frames hold ``column``."""
    l_names, r_names = left.select("column").distinct(), right.select("column").distinct()
    return l_names.join(r_names, "column", "left_anti").withColumn(
        "only_in", F.lit("left")
    ).unionByName(
        r_names.join(l_names, "column", "left_anti").withColumn("only_in", F.lit("right"))
    )


def column_presence(lines: DataFrame, column: str, by: Column, by_name: str) -> DataFrame:
    """Per group of lines: how many have the column, and whether any has."""
    has = F.array_contains(F.json_object_keys("value"), column)
    return (
        lines.groupBy(by.alias(by_name))
        .agg(F.count(F.lit(1)).alias("line_cnt"), F.count_if(has).alias("with_column_cnt"))
        .withColumn("present", F.col("with_column_cnt") > 0)
    )


def batch_metrics(df: DataFrame, nullable: str, ts: str) -> DataFrame:
    """Rows, NULL share of one column, first and last time of a batch."""
    return df.agg(*metric_columns(nullable, ts))


def metric_columns(nullable: str, ts: str) -> list[Column]:
    """The aggregates of ``batch_metrics``, to be computed by a scan or during a write.

    Without rows the share is NULL.
    """
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.try_divide(F.count_if(F.col(nullable).isNull()), F.count(F.lit(1))).alias(f"{nullable}_null_rate"),
        F.min(ts).alias("min_date"),
        F.max(ts).alias("max_date"),
    ]


def null_rate_history(df: DataFrame, columns: list[str], day: Column,
                      threshold: float) -> DataFrame:
    """(day, column, null_rate, previous_rate, drifted) over days.

    A column drifts on a day when its NULL share moved by more than ``threshold``
    against the day before; a share of 1 means the column vanished.  The window runs
    over one row per day and column.
    """
    daily = df.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_{i}") for i, c in enumerate(columns)],
    )
    long = daily.select("day", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), (F.col(f"_{i}") / F.col("_n")).alias("null_rate"))
        for i, c in enumerate(columns)
    ])).alias("e")).select("day", "e.column", "e.null_rate")
    window = Window.partitionBy("column").orderBy("day")
    previous = F.lag("null_rate").over(window)
    return long.withColumn("previous_rate", previous).withColumn(
        "drifted",
        F.coalesce(F.abs(F.col("null_rate") - F.col("previous_rate")) > threshold, F.lit(False)),
    )
