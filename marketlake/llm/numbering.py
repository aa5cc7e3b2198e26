"""Places of rows inside their group, without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.session import materialize

#: Rows of one range partition, on average.
ROWS_PER_TASK = 200_000


def numbered(rows: DataFrame, group: str, order: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``rows`` with ``pos``, the place of a row in its group from 0, and ``size``, the group's rows.

    ``rows`` is a written table and ``group`` a column without nulls; rows equal in ``order``
    stand in any order.  Range partitions cut a group of any size; each is numbered on its
    own, and a small table of one row a partition and group holds what stands before it.
    """
    tasks = max(1, -(-rows.count() // rows_per_task))
    spread = (
        rows.repartitionByRange(tasks, group, *order).sortWithinPartitions(group, *order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    spread = materialize(spread, "numbered")
    parts = spread.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_from")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy("_group")
    before = F.sum("_rows").over(whole.orderBy("_from")) - F.col("_rows")
    offsets = parts.select("_group", "_from", (before - F.col("_first")).alias("_shift"),
                           F.sum("_rows").over(whole).alias("size"))
    placed = spread.join(offsets, (F.col(group) == F.col("_group")) & (F.col("_part") == F.col("_from")))
    return placed.withColumn("pos", F.col("_at") + F.col("_shift")).drop(
        "_group", "_from", "_part", "_at", "_shift")


def with_sums_before(rows: DataFrame, order: list[str], sums: list[str],
                     rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``rows`` with ``step``, the place from 1 in ``order``, and ``<c>_before`` for each of ``sums``.

    ``<c>_before`` adds up ``c`` of all rows that come earlier.  ``rows`` is a written table
    whose ``order`` has no ties.  Range partitions are summed each on its own; only their
    totals, a row a partition, are added up in one place.
    """
    tasks = max(1, -(-rows.count() // rows_per_task))
    spread = materialize(
        rows.repartitionByRange(tasks, *order).withColumn("_part", F.spark_partition_id()), "in_order")
    parts = spread.groupBy(F.col("_part").alias("_from")).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_{c}") for c in sums])
    earlier = Window.orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_from", *[
        F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0)).alias(f"_{c}") for c in ("rows", *sums)])
    inside = Window.partitionBy("_part").orderBy(*order)
    above = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = spread.withColumns({
        "_step": F.row_number().over(inside),
        **{f"{c}_before": F.coalesce(F.sum(c).over(above), F.lit(0)) for c in sums},
    }).join(offsets, F.col("_part") == F.col("_from"))
    return placed.withColumns({
        "step": F.col("_step") + F.col("_rows"),
        **{f"{c}_before": F.col(f"{c}_before") + F.col(f"_{c}") for c in sums},
    }).select(*rows.columns, "step", *[f"{c}_before" for c in sums])
