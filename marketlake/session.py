"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings every job of this package expects.  All of them can be given to
# spark-submit instead; nothing here names a machine, bucket or secret.
LAKE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rank limits up to this size are applied before the shuffle as well.
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    # De-duplication state may outgrow the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def lake_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Build (or get) a session with the package's settings plus ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**LAKE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Pin the session zone; ``*_utc`` columns are zone-less UTC wall times."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder for written tables, under the cluster's shared checkpoint dir.

    A machine-local folder is only used by a local master, where the one machine
    is the whole cluster.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="marketlake-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written_table(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write a table under the shared folder and read it back; also returns its path."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def observed_table(df: DataFrame, label: str, metrics: list[Column],
                   rows_per_file: int = 0) -> tuple[DataFrame, str, dict]:
    """``written_table``, and aggregates of its rows that are computed while they are written.

    A file has at most ``rows_per_file`` rows, if that is given.

    The metrics belong to the stage that writes, where Spark counts each task once, so a
    repeated task changes nothing and the rows are not read again.
    """
    path, seen = scratch_path(df.sparkSession, label), Observation()
    df.observe(seen, *metrics).write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path, seen.get


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a table that several later steps read, and read it back.

    For plans and counts that are small beside the data: each step then starts from
    files in the shared folder, which survive the loss of executors.
    """
    return written_table(df, label)[0]


def _on_storage(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    files, where = _on_storage(spark, path)
    return files.exists(where)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that no later step reads."""
    files, where = _on_storage(spark, path)
    files.delete(where, True)
