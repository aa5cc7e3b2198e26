"""Compare layers: repeats, identical copies and column differences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators.dedup import distinct_rows_of_top_key, duplicate_share
from marketlake.operators.quality import line_keys, missing_columns, name_difference
from marketlake.sources.tables import path_date


def repeats_by_date(records: DataFrame, key: str = "id") -> DataFrame:
    """Share of repeated keys per bronze date, all dates in one job."""
    return duplicate_share(records, key, ["date"])


def copies_of_top_key(records: DataFrame, key: str = "id") -> DataFrame:
    return distinct_rows_of_top_key(records, [key])


def bronze_silver_difference(lines: DataFrame, silver: DataFrame) -> DataFrame:
    """Columns in raw lines but not in silver (``left``) and the other way (``right``)."""
    names = silver.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(c) for c in silver.columns])).alias("column")
    )
    return name_difference(line_keys(lines).select("column"), names)


def outlier_columns(lines: DataFrame) -> DataFrame:
    """(date, column, file_cnt) of columns missing from some files."""
    return (
        missing_columns(lines)
        .groupBy(path_date(F.col("file_path")).alias("date"), "column")
        .agg(F.count(F.lit(1)).alias("file_cnt"))
    )
