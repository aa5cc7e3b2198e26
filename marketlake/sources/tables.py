"""Parquet scans over Hive-style folders, path keys, file inventory and store settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_partitioned(
    spark: SparkSession, path: str, keys: tuple[str, ...] = ("year", "month", "day")
) -> DataFrame:
    """Read a partitioned Parquet table with its path keys as BIGINT columns."""
    df = spark.read.parquet(path)
    return df.withColumns({k: F.col(k).cast("bigint") for k in keys if k in df.columns})


def scan_day(spark: SparkSession, path: str, year: int, month: int, day: int) -> DataFrame:
    """One date partition, without the path keys as columns.

    The filter compares the partition columns themselves, so only that folder's
    files are listed in the scan.
    """
    return (
        spark.read.parquet(path)
        .filter((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day))
        .drop("year", "month", "day")
    )


def path_date(file_path: Column, key: str = "date") -> Column:
    """The ISO date after ``<key>=`` in a path."""
    return F.regexp_extract(file_path, key + r"=(\d{4}-\d{2}-\d{2})", 1).try_cast("date")


def path_parts_date(file_path: Column) -> Column:
    """A date from ``year=/month=/day=`` path parts, padded or not."""
    parts = [F.regexp_extract(file_path, rf"{k}=(\d+)", 1).try_cast("int")
             for k in ("year", "month", "day")]
    return F.make_date(*parts)


def file_inventory(df: DataFrame) -> DataFrame:
    """(file_path, file_size, row_cnt) of the files behind a file-based frame."""
    return (
        df.select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_size"),
        )
        .groupBy("file_path", "file_size")
        .agg(F.count(F.lit(1)).alias("row_cnt"))
    )


def object_store_conf(
    endpoint: str, access_key: str, secret_key: str, path_style: bool = True, tls: bool = False
) -> dict[str, str]:
    """Spark options for an S3-compatible store; credentials come from the caller."""
    prefix = "spark.hadoop.fs.s3a"
    return {
        f"{prefix}.endpoint": endpoint,
        f"{prefix}.access.key": access_key,
        f"{prefix}.secret.key": secret_key,
        f"{prefix}.path.style.access": str(path_style).lower(),
        f"{prefix}.connection.ssl.enabled": str(tls).lower(),
    }
