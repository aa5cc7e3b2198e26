"""Exact quantiles of many columns without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.session import materialize

_PER_UNIT = 256
_FINE = 65_536
#: Values of one range partition, on average at most.
VALUES_PER_TASK = 500_000


def _coarse(value: Column) -> Column:
    """A monotone bucket number; at most 400 000 buckets over all doubles."""
    scaled = F.asinh(value) * _PER_UNIT
    return F.floor(F.greatest(F.least(scaled, F.lit(2e5)), F.lit(-2e5)))


def _fine(value: Column, coarse: Column) -> Column:
    """A monotone sub-bucket number between the ends of a coarse bucket.

    Values outside finite ends share sub-bucket 0, which only makes it larger.
    """
    low, high = F.sinh(coarse / _PER_UNIT), F.sinh((coarse + 1) / _PER_UNIT)
    share = F.nanvl(F.try_divide(value - low, high - low), F.lit(0.0))
    return F.floor(F.greatest(F.least(share, F.lit(1.0)), F.lit(0.0)) * _FINE)


def _bucket_holding(counts: DataFrame, inside: list[str], order: str) -> DataFrame:
    """Add ``before`` and ``upto``: rows ranked below and up to each bucket."""
    window = Window.partitionBy(*inside).orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return counts.withColumn("upto", F.sum("n").over(window)).withColumn(
        "before", F.col("upto") - F.col("n")
    )


def _exact(df: DataFrame, name: str) -> Column:
    """The value as a decimal with room for 64-bit integers, NULL for floating columns."""
    kind = df.schema[name].dataType
    exact = isinstance(kind, (T.IntegralType, T.DecimalType))
    return (F.col(f"`{name}`") if exact else F.lit(None)).cast("decimal(38,6)")


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                    method: str = "linear") -> DataFrame:
    """(column, prob, value, exact) with the exact quantiles of numeric columns.

    ``value`` is a double.  ``exact`` is the same as DECIMAL(38, 6) for integer and
    decimal columns, whose digits a double may not hold, and NULL for others.  NaN ranks
    above every number, as in Spark's order; NULLs are left out.

    ``method`` is ``linear`` (interpolated) or ``nearest`` (the element at rank
    ``round(q * (n - 1))``).  Ranks are located by narrowing: a coarse histogram of
    all values, a fine one inside the buckets that hold a wanted rank, then the
    different values of those sub-buckets, which may be most of a column whose numbers
    lie close together: range partitions cut them, and only those that hold a wanted
    rank are sorted, each on its own.  Each pass scans the columns once and shuffles only
    counts, so neither the number of rows nor one very frequent value is collected in
    a task.  The located ranks, at most two per column and probability, are written
    between passes.
    """
    values = (
        df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("v"),
                     _exact(df, c).alias("x"))
            for c in columns
        ])).alias("e"))
        .select("e.column", "e.v", "e.x")
        .filter(F.col("v").isNotNull())
        .withColumn("k1", _coarse(F.col("v")))
    )
    n_rows = F.count(F.lit(1)).alias("n")
    level1 = _bucket_holding(values.groupBy("column", "k1").agg(n_rows), ["column"], "k1")
    whole = Window.partitionBy("column").orderBy("k1").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    position = F.col("prob") * (F.col("total") - 1)
    if method == "nearest":
        ends = F.array(F.round(position).cast("bigint"))
    else:
        ends = F.array_distinct(F.array(F.floor(position), F.ceil(position)))
    wanted1 = materialize(
        level1.withColumn("total", F.sum("n").over(whole))
        .withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("share", position - F.floor(position))
        .withColumn("rank", F.explode(ends))
        .filter((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("upto")))
        .select("column", "k1", "prob", "share", "rank",
                (F.col("rank") - F.col("before")).alias("r1")),
        "quantile_ranks",
    )
    # At most two ranks per column and probability: small enough to broadcast.
    within1 = values.join(F.broadcast(wanted1), ["column", "k1"], "left_semi").withColumn(
        "k2", _fine(F.col("v"), F.col("k1"))
    )

    level2 = _bucket_holding(
        within1.groupBy("column", "k1", "k2").agg(n_rows),
        ["column", "k1"], "k2",
    )
    wanted2 = materialize(
        level2.join(wanted1, ["column", "k1"])
        .filter((F.col("before") <= F.col("r1")) & (F.col("r1") < F.col("upto")))
        .select("column", "k1", "k2", "n", "prob", "share", "rank",
                (F.col("r1") - F.col("before")).alias("r2")),
        "quantile_ranks",
    )
    within2 = within1.join(F.broadcast(wanted2), ["column", "k1", "k2"], "left_semi")

    # Equal doubles may differ as decimals, so the last ranks are by both.
    inside = ["column", "k1", "k2"]
    rows = wanted2.select(*inside, "n").distinct().agg(F.sum("n")).first()[0] or 0
    spread = materialize(
        within2.groupBy(*inside, "v", "x").agg(n_rows)
        .repartitionByRange(max(1, -(-rows // VALUES_PER_TASK)), *inside, "v", "x")
        .withColumn("part", F.spark_partition_id()),
        "quantile_values",
    )
    level3 = _bucket_holding(spread.groupBy(*inside, "part").agg(F.sum("n").alias("n")), inside, "part")
    wanted3 = materialize(
        level3.join(wanted2.drop("n"), inside)
        .filter((F.col("before") <= F.col("r2")) & (F.col("r2") < F.col("upto")))
        .select(*inside, "part", "prob", "share", "rank", (F.col("r2") - F.col("before")).alias("r3")),
        "quantile_ranks",
    )
    inside = [*inside, "part"]
    level4 = _bucket_holding(
        spread.join(F.broadcast(wanted3), inside, "left_semi").withColumn("vx", F.struct("v", "x")), inside, "vx")
    found = (
        level4.join(wanted3, inside)
        .filter((F.col("before") <= F.col("r3")) & (F.col("r3") < F.col("upto")))
        .groupBy("column", "prob")
        .agg(F.min("vx").alias("low"), F.max("vx").alias("high"), F.first("share").alias("share"))
    )
    if method == "nearest":
        return found.select("column", "prob", F.col("low.v").alias("value"), F.col("low.x").alias("exact"))
    between = F.col("low.v") + (F.col("high.v") - F.col("low.v")) * F.col("share")
    # Equal ends need no arithmetic, which would turn infinities into NaN.
    value = F.when(F.col("low.v") == F.col("high.v"), F.col("low.v")).otherwise(between)
    gap = (F.col("high.x") - F.col("low.x")) * F.col("share").cast("decimal(9,8)")
    return found.select("column", "prob", value.alias("value"),
                        (F.col("low.x") + gap).cast("decimal(38,6)").alias("exact"))
