"""Approximate distinct counts from mergeable sketches, a small row a day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Logarithm of a sketch's registers; the standard error is about 1.04 / sqrt(2 ** PRECISION), 1.6 %.
PRECISION = 12


def daily_sketches(df: DataFrame, day: Column, value: str, precision: int = PRECISION) -> DataFrame:
    """(day, sketch): one HyperLogLog sketch a day, made in one scan.

    Sketches merge inside each input task before the shuffle, so a day of any size sends one
    small row a task.  Null values are not counted; rows without a day get a null day.
    """
    return df.groupBy(day.alias("day")).agg(F.hll_sketch_agg(value, precision).alias("sketch"))


def distinct_in_ranges(sketches: DataFrame, ranges: DataFrame) -> DataFrame:
    """(first_day, last_day, estimate): distinct values of every range of days, ends included.

    Only the sketches are read, never the rows again; a range without days counts 0.
    """
    days = ranges.withColumn("day", F.explode(F.sequence("first_day", "last_day")))
    return days.join(sketches, "day", "left").groupBy("first_day", "last_day").agg(
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).cast("long").alias("estimate"))
