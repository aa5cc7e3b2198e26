"""Date spines, daily count series and their summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_spine(df: DataFrame, ts: Column, days: int) -> DataFrame:
    """The last ``days`` calendar days ending at the newest day of ``df``: (day, idx)."""
    end = df.agg(F.to_date(F.max(ts)).alias("end"))
    start = F.date_sub(F.col("end"), days - 1)
    return end.select(F.posexplode(F.sequence(start, F.col("end"))).alias("idx", "day")).select(
        "day", F.col("idx").cast("bigint").alias("idx")
    )


def daily_counts(df: DataFrame, ts: Column, spine: DataFrame) -> DataFrame:
    """Rows per spine day, zero where there are none: (day, idx, found)."""
    counts = df.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("found"))
    return spine.join(counts, "day", "left").select(
        "day", "idx", F.coalesce("found", F.lit(0)).cast("bigint").alias("found")
    )


def describe_counts(counts: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles (linear), max of a short count series.

    For series bounded by a calendar or a dictionary of areas; use
    ``quantiles.exact_quantiles`` for columns of big tables.
    """
    v = F.col(value).cast("double")
    quartile = lambda q: F.round(F.percentile(v, F.lit(q)), 6)
    return counts.groupBy(*(by or [])).agg(
        F.count(v).alias("count"),
        F.round(F.avg(v), 6).alias("mean"),
        F.round(F.stddev_samp(v), 6).alias("std"),
        F.min(v).alias("min"),
        quartile(0.25).alias("p25"),
        quartile(0.5).alias("p50"),
        quartile(0.75).alias("p75"),
        F.max(v).alias("max"),
    )
