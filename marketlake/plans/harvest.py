"""Slice plan to bounded batches: cut by time, drill by dimension, page, write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.times import MOSCOW, zone_day
from marketlake.session import materialize
from marketlake.sinks.writers import write_ledger
from marketlake.operators.slices import (
    DAILY_WALK,
    WalkRules,
    daily_second_counts,
    drill_slices,
    rows_in_slices,
    walk_slices,
    with_pages,
)


def plan_days(df: DataFrame, utc: Column, cap: int, rules: WalkRules = DAILY_WALK,
              zone: str = MOSCOW) -> DataFrame:
    """Adaptive slices of every calendar day of ``zone``, and one of the rows without a time."""
    return walk_slices(daily_second_counts(df, utc, zone), cap, rules)


def batch_rows(df: DataFrame, utc: Column, key: Column, dims: dict[str, Column], cap: int,
               per_page: int = 100, rules: WalkRules = DAILY_WALK,
               zone: str = MOSCOW) -> DataFrame:
    """Rows with the (run, first_second, dims..., page) unit each belongs to.

    Slices over the cap are cut by ``dims``; a unit that is still over it gets more
    pages, so no row is lost.  Rows without a time are a unit with a NULL run.
    """
    slices = materialize(plan_days(df, utc, cap, rules, zone), "slices")
    rows = rows_in_slices(df, utc, zone_day(utc, zone), slices)
    slice_keys = ["run", "first_second", "last_second"]
    names = [f"dim_{n}" for n in dims]
    rows = rows.withColumns(dict(zip(names, dims.values())))
    drilled = drill_slices(
        rows.filter("over_cap"), slice_keys, {n: F.col(n) for n in names}, cap
    )
    # Depth per full dimension path: few rows per over-cap slice.
    depth = materialize(
        drilled.select(*slice_keys, *[F.col(n).alias(f"_{n}") for n in names], "depth"), "drilled"
    )
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"d.{k}")) for k in slice_keys] + [
        (F.col("d.depth") <= i) | F.col(f"r.{n}").eqNullSafe(F.col(f"d._{n}"))
        for i, n in enumerate(names)
    ]
    joined = rows.alias("r").join(depth.alias("d"), same, "left").select(
        "r.*", F.coalesce("d.depth", F.lit(0)).alias("depth")
    )
    unit = joined.withColumns({
        n: F.when(F.col("depth") > i, F.coalesce(F.col(n).cast("string"), F.lit("(none)")))
        for i, n in enumerate(names)
    }).drop("over_cap", "depth")
    # NULL marks an unused dimension.
    parts = [F.col(c).cast("string") for c in ["run", "first_second", *names]]
    unit = unit.fillna("(all)", subset=names).withColumn("unit", F.to_json(F.array(*parts)))
    return with_pages(unit, ["unit"], utc, key, per_page).drop("unit", "rn")


def ledger_over_cap(slices: DataFrame, path: str, run: str) -> None:
    """Write the windows that stayed over the cap, as one run of the ledger."""
    write_ledger(slices.filter("over_cap").withColumnRenamed("run", "day"), path, run)
