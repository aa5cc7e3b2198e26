"""Writers: Parquet, JSON-lines batches, idempotent day partitions, ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators.dedup import keep_latest, row_hash
from marketlake.session import discard, path_exists, written_table

DAY_KEYS = ("year", "month", "day")


def write_parquet(df: DataFrame, path: str, level: int | None = None,
                  row_group_bytes: int | None = None) -> None:
    """ZSTD Parquet straight from the executors."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if level is not None:
        writer = writer.option("parquet.compression.codec.zstd.level", level)
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def write_jsonl_batches(df: DataFrame, path: str, rows_per_file: int = 10_000,
                        partition_by: tuple[str, ...] = ()) -> None:
    """gz JSON lines, at most ``rows_per_file`` rows a file, NULL fields kept."""
    writer = (
        df.write.mode("overwrite")
        .option("compression", "gzip")
        .option("ignoreNullFields", "false")
        .option("maxRecordsPerFile", rows_per_file)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)


def with_day_keys(df: DataFrame, ts: str | Column) -> DataFrame:
    """Add integer ``year, month, day`` columns taken from a timestamp.

    Rows without a timestamp go to partition 0/0/0, so equality joins on the keys
    (and partition pruning through them) reach them too.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    parts = {"year": F.year(ts), "month": F.month(ts), "day": F.day(ts)}
    return df.withColumns(
        {k: F.coalesce(v, F.lit(0)).cast("bigint") for k, v in parts.items()}
    )


def overwrite_days(df: DataFrame, path: str, keys: tuple[str, ...] = DAY_KEYS) -> None:
    """Replace exactly the partitions present in ``df``; other partitions stay.

    The rebalance hint groups rows of a day into few files and lets adaptive
    execution split a day that is much larger than the others.  A frame without
    rows replaces nothing.
    """
    (
        df.hint("rebalance", *[F.col(k) for k in keys])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*keys)
        .parquet(path)
    )


def _stored(df: DataFrame, path: str) -> DataFrame | None:
    """The stored table with the columns of ``df``; None if nothing is at ``path`` yet."""
    if not path_exists(df.sparkSession, path):
        return None
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _rows_of_days(stored: DataFrame, touched: DataFrame) -> DataFrame:
    """Stored rows of the touched days; other partitions are not opened.

    ``touched`` is a written table of a few rows, so the join is a broadcast one, and
    its filter makes Spark prune the partitions of ``stored`` by the days it finds.
    """
    some = touched.filter(F.col(DAY_KEYS[0]) >= 0)
    return stored.join(some, list(DAY_KEYS), "left_semi")


def merge_days(df: DataFrame, path: str, key: str, order: list[Column],
               is_table: bool = False) -> None:
    """Upsert rows into day partitions, keeping the first row of a key in ``order``.

    ``df`` holds one row per key and day where nothing is stored yet.  Late rows belong to days that earlier runs
    wrote, so the stored rows of the days touched by ``df`` are merged in before those
    days are replaced.  The merged days go to a staging table first: a job must not
    read the files it overwrites, and the staged copy lets a run that died half-way
    through the replace be finished.  The copies made here are deleted after the
    replace; ``is_table`` says that ``df`` already reads a written table.
    """
    stored = _stored(df, path)
    if stored is None:
        overwrite_days(df, path)
        return
    spark = df.sparkSession
    copies = []
    new = df
    if not is_table:
        new, batch_path = written_table(df, "batch")
        copies.append(batch_path)
    touched, days_path = written_table(new.select(*DAY_KEYS).distinct(), "days")
    both = new.unionByName(_rows_of_days(stored, touched))
    merged = keep_latest(both, [key, *DAY_KEYS], [*order, row_hash(both).desc()])
    staged, staging_path = written_table(merged, "staging")
    overwrite_days(staged, path)
    for scratch in [*copies, days_path, staging_path]:
        discard(spark, scratch)


def write_ledger(df: DataFrame, path: str, run: str) -> None:
    """Write the rejected rows, failed windows or reports of one run as JSON lines.

    Every run has a folder ``run=...`` of its own that a re-run replaces as a whole, so
    nothing is doubled, and what a repeated run no longer finds goes.
    """
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/run={run}")


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Name a frame for SQL and return it."""
    df.createOrReplaceTempView(name)
    return df
