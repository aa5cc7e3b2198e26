"""Column profiles generated from the schema, one pass for all columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.quantiles import exact_quantiles


def _name(c: str) -> Column:
    return F.col(f"`{c}`")


def null_counts(df: DataFrame) -> DataFrame:
    """One row: number of NULLs in every column, under the column's name."""
    return df.agg(*[F.count_if(_name(c).isNull()).alias(c) for c in df.columns])


def _per_column(df: DataFrame, columns: list[str], **measures) -> DataFrame:
    """Aggregate all columns at once, then turn the one row into a row per column."""
    row = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[make(c).alias(f"{i}_{m}") for i, c in enumerate(columns)
          for m, make in measures.items()],
    )
    entries = [
        F.struct(F.lit(c).alias("column"),
                 *[F.col(f"{i}_{m}").alias(m) for m in measures])
        for i, c in enumerate(columns)
    ]
    return row.select("_total", F.explode(F.array(*entries)).alias("e")).select(
        "e.column", F.col("_total").alias("total_cnt"), *[f"e.{m}" for m in measures]
    )


def _percent(part: Column, total: Column, digits: int) -> Column:
    return F.round(part / total * 100, digits)


def null_report(df: DataFrame) -> DataFrame:
    """(column, total_cnt, null_cnt, null_pcnt) for every column."""
    out = _per_column(df, df.columns, null_cnt=lambda c: F.count_if(_name(c).isNull()))
    return out.withColumn("null_pcnt", _percent(F.col("null_cnt"), F.col("total_cnt"), 1))


def list_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]


def empty_list_report(df: DataFrame) -> DataFrame:
    """(column, total_cnt, empty_list_cnt, empty_pcnt) for every list column."""
    out = _per_column(
        df, list_columns(df), empty_list_cnt=lambda c: F.count_if(F.size(_name(c)) == 0)
    )
    return out.withColumn("empty_pcnt", _percent(F.col("empty_list_cnt"), F.col("total_cnt"), 1))


def null_and_empty_report(df: DataFrame) -> DataFrame:
    """NULL counts of all columns with the empty-list counts of list columns, in one pass."""
    lists = set(list_columns(df))
    out = _per_column(
        df, df.columns,
        null_cnt=lambda c: F.count_if(_name(c).isNull()),
        empty_list_cnt=lambda c: (F.count_if(F.size(_name(c)) == 0) if c in lists
                                  else F.max(F.lit(None).cast("bigint"))),
    )
    return out.select(
        "column", "total_cnt", "null_cnt", _percent(F.col("null_cnt"), F.col("total_cnt"), 1).alias("null_pcnt"),
        "empty_list_cnt", _percent(F.col("empty_list_cnt"), F.col("total_cnt"), 1).alias("empty_pcnt"),
    )


def list_reports(df: DataFrame, columns: list[str], k: int = 10) -> DataFrame:
    """(column, value, len, cnt): the k most frequent values of each list column, in one scan.

    Only the k best of a task's values of a column are ranked in one place.
    """
    values = [F.struct(F.lit(c).alias("column"), F.to_json(_name(c)).alias("value"),
                       F.array_size(_name(c)).cast("bigint").alias("len")) for c in columns]
    counts = df.select(F.explode(F.array(*values)).alias("v")).groupBy("v.column", "v.value", "v.len").agg(
        F.count(F.lit(1)).alias("cnt"))
    best = Window.partitionBy("column").orderBy(F.col("cnt").desc(), F.col("value").asc_nulls_first())
    return counts.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= k).drop("_rank")


def fill_report(df: DataFrame, field: str) -> DataFrame:
    """Filled, distinct and NULL counts of one field, with two NULL percentages.

    ``null_prcnt`` relates NULLs to filled rows (so it can pass 100), ``null_share`` to
    all rows.
    """
    return df.select(F.col(field).alias("v")).agg(
        F.count("v").alias("rows_cnt"),
        F.count_distinct("v").alias("unique_cnt"),
        F.count_if(F.col("v").isNull()).alias("null_cnt"),
    ).withColumns({
        "null_prcnt": F.round(F.try_divide(F.col("null_cnt"), F.col("rows_cnt")) * 100, 2),
        "null_share": F.round(
            F.try_divide(F.col("null_cnt"), F.col("rows_cnt") + F.col("null_cnt")) * 100, 2),
    })


def list_column_report(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values of a list column: (value, len, cnt), value as JSON."""
    items = _name(column)
    return (
        df.groupBy(items.alias("v"))
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select(F.to_json("v").alias("value"), F.array_size("v").cast("bigint").alias("len"), "cnt")
        .orderBy(F.col("cnt").desc(), F.col("value").asc_nulls_first())
        .limit(k)
    )


def list_length_stats(df: DataFrame, column: str) -> DataFrame:
    """min, max, mean, median (interpolated) and nearest-rank p25/p75/p95 of list lengths.

    Works on a histogram of lengths, which has at most one row per distinct length.
    """
    hist = (
        df.select(F.array_size(_name(column)).cast("bigint").alias("len"))
        .filter("len is not null").groupBy("len").agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = hist.withColumn("total", F.sum("n").over(Window.partitionBy())).withColumn(
        "upto", F.sum("n").over(Window.orderBy("len"))
    )

    def nearest(prob: float) -> Column:
        rank = F.round(F.lit(prob) * (F.col("total") - 1))
        return F.min(F.when(F.col("upto") > rank, F.col("len")))

    return ranked.agg(
        F.min("len").alias("min_len"), F.max("len").alias("max_len"),
        F.round(F.sum(F.col("len") * F.col("n")) / F.sum("n"), 6).alias("avg_len"),
        F.percentile("len", F.lit(0.5), F.col("n")).alias("median_len"),
        *[nearest(p).alias(f"p{int(p * 100)}_len") for p in (0.25, 0.75, 0.95)],
    )


def column_summary(df: DataFrame) -> DataFrame:
    """count, null_count, mean, std, min, quartiles, max of every plain column.

    Numbers give double statistics; text, dates and flags give ``first_value`` and
    ``last_value`` in text order.  Quartiles are nearest-rank elements.
    """
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    plain = [
        f.name for f in df.schema
        if not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
    ]

    def number(make):
        return lambda c: (make(_name(c).cast("double")) if c in numeric
                          else F.max(F.lit(None).cast("double")))

    def text(make):
        return lambda c: (F.max(F.lit(None).cast("string")) if c in numeric
                          else make(_name(c).cast("string")))

    base = _per_column(
        df, plain,
        count=lambda c: F.count(_name(c)),
        null_count=lambda c: F.count_if(_name(c).isNull()),
        mean=number(F.avg), std=number(F.stddev_samp), min=number(F.min), max=number(F.max),
        first_value=text(F.min), last_value=text(F.max),
    )
    if not numeric:
        return base
    quartiles = exact_quantiles(df, numeric, [0.25, 0.5, 0.75], "nearest").groupBy("column").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"p{int(p * 100)}")
        for p in (0.25, 0.5, 0.75)
    ])
    return base.join(quartiles, "column", "left")
