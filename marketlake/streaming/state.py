"""Streams whose memory is Spark's own state: first rows of a key, windows that close, rows that come late."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

# The processor travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: State on disk, of which a micro-batch writes its changes only.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _settings(spark: SparkSession, state_partitions: int | None) -> Iterator[None]:
    """Settings that a query copies when it starts; the session's own come back after."""
    wanted = dict(STATE_CONF)
    if state_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def publish_first_rows(records: DataFrame, path: str, checkpoint: str, key: str = "id", salts: int = 16,
                       state_partitions: int | None = None) -> StreamingQuery:
    """The first row of every key of a stream, whole, appended to a Parquet table exactly once.

    The keys seen are state in RocksDB, spread by key: a micro-batch looks up its own keys,
    however many came before.  Nothing is forgotten, so a key is kept however late it
    comes, a null key too; of a key's rows in one micro-batch any is the first.  Repeats are
    dropped inside (key, salt) before, so at most ``salts`` rows of a very frequent key ever
    reach its task.
    """
    salted = records.withColumn("_salt", F.floor(F.rand(0) * salts)).dropDuplicates([key, "_salt"])
    with _settings(records.sparkSession, state_partitions):
        return (
            salted.drop("_salt").dropDuplicates([key]).writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        )


class WindowCounter(StatefulProcessor):
    """Counts the rows of a window until the watermark passes its end; later rows come out as they are.

    The key is the window's end, the columns counted by and a salt.  A window comes out once,
    by a timer at its end, as a row with ``found``; a late row at once, with itself in ``late_row``.
    """

    def __init__(self, names: list[str]):
        self.names = names

    def init(self, handle) -> None:
        self.handle = handle
        self.count = handle.getValueState("found", "found long")

    def _out(self, key, found: list[int], late_rows: list[str | None]) -> pd.DataFrame:
        own = {n: pd.Series([v] * len(found), dtype=object) for n, v in zip(self.names, key)}
        own["end_ms"] = own["end_ms"].astype("int64")
        return pd.DataFrame({**own, "found": found, "late_row": pd.Series(late_rows, dtype=object)})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[0] <= timerValues.getCurrentWatermarkInMs():
            for part in rows:
                yield self._out(key, [1] * len(part), part["row"].tolist())
            return
        found = sum(len(part) for part in rows)
        if self.count.exists():
            found += self.count.get()[0]
        else:
            self.handle.registerTimer(key[0])
        self.count.update((found,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        found = self.count.get()[0]
        self.count.clear()
        yield self._out(key, [found], [None])

    def close(self) -> None:
        pass


def publish_watermarked_windows(events: DataFrame, ts: str, width: str, delay: str, path: str, checkpoint: str,
                                by: list[str] | None = None, salts: int = 4,
                                state_partitions: int | None = None) -> StreamingQuery:
    """Counts of tumbling windows that close at Spark's watermark, and every row that comes after.

    The table has rows of closed windows under ``late=false`` and late rows, whole as JSON, under
    ``late=true``; windows still open are in the state, where ``open_windows`` reads them.  The
    three add up to the rows read, but for those without a time, which belong to no window.
    ``by`` names text columns.  A window's rows are spread over ``salts`` states.
    """
    by = by or []
    names = ["end_ms", *by, "salt"]
    timed = events.withColumn("_t", F.col(ts).cast("timestamp")).withWatermark("_t", delay).filter("_t is not null")
    # The state's input has no watermark column, from which Spark would drop late rows unseen.
    rows = timed.select(
        F.unix_millis(F.window("_t", width)["end"]).alias("end_ms"), *by, F.floor(F.rand(0) * salts).alias("salt"),
        F.to_json(F.struct(*events.columns)).alias("row"))
    schema = ", ".join(["end_ms long", *[f"`{c}` string" for c in by], "salt long", "found long", "late_row string"])
    with _settings(events.sparkSession, state_partitions):
        out = rows.groupBy(*names).transformWithStateInPandas(
            WindowCounter(names), schema, outputMode="Append", timeMode="EventTime")
        return (
            out.withColumn("late", F.col("late_row").isNotNull()).writeStream.format("parquet").partitionBy("late")
            .option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start()
        )


def _end(end_ms) -> F.Column:
    return F.timestamp_millis(end_ms).cast("timestamp_ntz").alias("end")


def published_windows(spark: SparkSession, path: str, by: list[str] | None = None) -> DataFrame:
    """(end, by..., closed, late): rows counted in time, of windows that are closed, and rows that came late."""
    late = F.col("late_row").isNotNull()
    return spark.read.parquet(path).groupBy(_end("end_ms"), *(by or [])).agg(
        F.coalesce(F.sum(F.when(~late, F.col("found"))), F.lit(0)).alias("closed"), F.count_if(late).alias("late"))


def open_windows(spark: SparkSession, checkpoint: str, by: list[str] | None = None) -> DataFrame:
    """(end, by..., open): rows of the windows that are not closed yet, from the state itself."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "found").load()
    return state.groupBy(_end("key.end_ms"), *[F.col(f"key.{c}").alias(c) for c in by or []]).agg(
        F.sum("value.found").alias("open"))
