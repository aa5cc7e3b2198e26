"""Incremental forms of the daily batch on Structured Streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake.functions.times import utc_of_text
from marketlake.operators.dedup import keep_latest, row_hash
from marketlake.plans.silver import as_log, enrich, latest_first, line_counts, publish_parsed
from marketlake.session import discard, observed_table, path_exists
from marketlake.sinks.writers import DAY_KEYS, merge_days, with_day_keys, write_ledger
from marketlake.sources.jsonl import parsed_lines

#: Rows of a file of parsed lines.  A record is many times as large in memory as in a file, and
#: Spark takes a bounded number of files into a task, so small ones bound the rows that it sorts.
PARSED_ROWS = 20_000


def stream_to_silver(records: DataFrame, silver_path: str, checkpoint: str,
                     tie_break: list[str] | None = None,
                     ledger_path: str | None = None) -> StreamingQuery:
    """Bring all new files of a stream into the silver days; returns the finished query.

    Silver ends with the newest version of each id in each publication day, however
    the files were split into micro-batches; late rows go to the day they were published.
    A micro-batch writes its typed rows under the checkpoint, in a folder that a replay
    replaces.  Whenever the micro-batches of this checkpoint have doubled, and when no
    file is left, the written ones are merged into the days they touch and deleted, so a row
    of silver is written again a bounded number of times on average, not once a micro-batch.
    The merge is idempotent: what a run leaves that dies, the next one merges, with or
    without new files.  With a ``ledger_path`` every micro-batch writes how many lines it read
    and how many had no id (broken lines have none), which silver leaves out.
    """
    spark = records.sparkSession
    waiting = f"{checkpoint}/to_merge"

    def typed(batch: DataFrame) -> DataFrame:
        return with_day_keys(enrich(batch), "published_at_utc")

    schema = typed(records).schema

    def merge() -> None:
        rows = spark.read.schema(schema).parquet(f"{waiting}/batch=*")
        order = latest_first(tie_break)
        if not path_exists(spark, silver_path):
            rows = keep_latest(rows, ["id", *DAY_KEYS], [*order, row_hash(rows).desc()])
        # With stored days the merge itself keeps the newest row, so it takes all versions.
        merge_days(rows, silver_path, "id", order, is_table=True)
        discard(spark, waiting)

    def land(batch: DataFrame, batch_id: int) -> None:
        if ledger_path:
            counts = batch.agg(F.count(F.lit(1)).alias("lines_read"),
                               F.count_if(F.col("id").isNull()).alias("lines_without_id"))
            write_ledger(counts, ledger_path, f"batch-{batch_id}")
        typed(batch).write.mode("overwrite").option("compression", "zstd").parquet(f"{waiting}/batch={batch_id}")
        if (batch_id + 1).bit_count() == 1:  # 1, 2, 4, 8, ... micro-batches so far
            merge()

    query = (
        records.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if path_exists(spark, waiting):
        merge()
    return query


def stream_run(lines: DataFrame, silver_path: str, ledger_path: str, log_path: str, checkpoint: str,
               tie_break: list[str] | None = None) -> None:
    """Take all new files of a stream of raw lines into silver, with the ledger of ``silver_run``.

    A micro-batch only appends its lines to ``log_path``, in a folder that a replay
    replaces.  When the stream has no more files, the logged lines are parsed once, by all
    tasks and with one plan and not one a micro-batch, and one merge brings them into the silver
    days they touch; silver ends as with ``stream_to_silver``, the newest version of an id in each day.
    Quarantine, drift and metrics have an entry a run, named after its first batch.

    ``merged`` in the ledger notes the last batch that silver has, and the log is deleted
    after that note.  A run that dies leaves its batches in the log: the next one takes them
    again under the same name, which replaces what was written, or skips those noted.
    A log belongs to one checkpoint, and only one run may use it at a time.
    """
    spark = lines.sparkSession

    def land(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("compression", "zstd").parquet(f"{log_path}/batch={batch_id}")

    query = (
        lines.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if not path_exists(spark, log_path):
        return
    marks = f"{ledger_path}/merged"
    done = -1
    if path_exists(spark, marks):
        last = spark.read.schema("last_batch bigint").json(marks).agg(F.max("last_batch")).first()[0]
        done = -1 if last is None else last
    log = spark.read.schema("value string, file_path string, batch long").option("basePath", log_path).parquet(log_path)
    parsed, parsed_path, counts = observed_table(
        as_log(parsed_lines(log.filter(F.col("batch") > done))), "parsed",
        [*line_counts(), F.max("batch").alias("last_batch")], rows_per_file=PARSED_ROWS)
    last = counts.pop("last_batch")
    if last is not None:
        rows = with_day_keys(enrich(parsed.select("record.*")), "published_at_utc")
        newest = keep_latest(rows, ["id", *DAY_KEYS], [*latest_first(tie_break), row_hash(rows).desc()])
        run = f"batch-{done + 1}"
        publish_parsed(parsed, counts, newest, silver_path, ledger_path, run, tie_break)
        write_ledger(spark.range(1).select(F.lit(last).cast("bigint").alias("last_batch")), marks, run)
    discard(spark, parsed_path)
    discard(spark, log_path)


def with_event_time(records: DataFrame) -> DataFrame:
    """Add ``event_time``; watermarks need an instant, not a zone-less time."""
    return records.withColumn(
        "event_time", utc_of_text(F.col("published_at")).cast("timestamp")
    )


def first_seen(records: DataFrame, delay: str, salts: int = 16) -> DataFrame:
    """Drop repeats of an id across files; state older than ``delay`` is forgotten.

    Rows behind the watermark are dropped, so an id whose first row comes later than ``delay``
    never appears: ``publish_first_seen`` keeps it.  Repeats are first dropped inside
    (id, salt), so the copies of a very frequent id are spread over tasks, and at most
    ``salts`` of them reach the final step.
    """
    # A seeded draw per row: a re-run of a scan task draws the same numbers.
    salted = with_event_time(records).withColumn("_salt", F.floor(F.rand(0) * salts))
    return (
        salted.withWatermark("event_time", delay)
        .dropDuplicatesWithinWatermark(["id", "_salt"])
        .drop("_salt")
        .dropDuplicatesWithinWatermark(["id"])
    )


def publish_first_seen(records: DataFrame, path: str, checkpoint: str, key: str = "id") -> StreamingQuery:
    """Every key of a stream once, as a table that is complete after every micro-batch.

    Each micro-batch writes the keys that no earlier one has to a folder ``batch=<id>``, which
    a replay replaces.  There is no watermark and no state that forgets: a key is kept however
    late it comes, a null key too.  Keys are made distinct inside each input task before the
    shuffle, so a very frequent one sends one row a task.
    """
    def land(batch: DataFrame, batch_id: int) -> None:
        new = batch.select(F.col(key).alias(key)).distinct()
        if batch_id:
            stored = batch.sparkSession.read.schema(new.schema.add("batch", "long")).option(
                "basePath", path).parquet(path)
            before = stored.filter(F.col("batch") < batch_id).select(F.col(key).alias("_seen"))
            new = new.join(before, F.col(key).eqNullSafe(F.col("_seen")), "left_anti")
        new.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        records.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _windows(timed: DataFrame, width: str, by: list[str] | None, *more: Column) -> DataFrame:
    return (
        timed.groupBy(F.window("_t", width), *(by or []))
        .agg(F.count(F.lit(1)).alias("found"), *more)
        .withColumns({
            "start": F.col("window.start").cast("timestamp_ntz"),
            "end": F.col("window.end").cast("timestamp_ntz"),
        })
        .drop("window")
    )


def window_counts(events: DataFrame, ts: str, width: str, delay: str | None,
                  by: list[str] | None = None) -> DataFrame:
    """Tumbling-window counts; with a ``delay`` a window is emitted once the watermark
    passes its end, and rows that come later still are dropped (``publish_closed_windows``
    keeps and counts them).
    """
    timed = events.withColumn("_t", F.col(ts).cast("timestamp"))
    found = _windows(timed.withWatermark("_t", delay) if delay else timed, width, by)
    return found.select("start", "end", *(by or []), "found")


def publish_window_counts(events: DataFrame, ts: str, width: str, path: str, checkpoint: str,
                          by: list[str] | None = None) -> StreamingQuery:
    """Counts of tumbling windows as a table that is complete after every micro-batch.

    Each micro-batch writes its own counts to a folder ``batch=<id>``, which a replay
    replaces; ``read_window_counts`` adds them up.  There is no state and no watermark,
    so open windows are published and a row counts however late it comes.
    """
    def land(batch: DataFrame, batch_id: int) -> None:
        window_counts(batch, ts, width, None, by).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        events.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_window_counts(spark: SparkSession, path: str, by: list[str] | None = None) -> DataFrame:
    """(start, end, by..., found) over all micro-batches so far."""
    return spark.read.parquet(path).groupBy("start", "end", *(by or [])).agg(F.sum("found").alias("found"))


def publish_closed_windows(events: DataFrame, ts: str, width: str, delay: str, path: str, checkpoint: str,
                           by: list[str] | None = None) -> StreamingQuery:
    """Counts of windows that close once the watermark passes their end, with all rows accounted for.

    The watermark is the newest time of all micro-batches before, less ``delay``; a row whose
    window it has passed is late.  Each micro-batch writes folders ``batch=<id>``, which a
    replay replaces: ``counts`` (by window, and whether late), ``rows`` (rows read, late and
    without a time, and the watermark after it) and ``late`` (the late rows themselves).
    ``read_closed_windows`` and ``read_accounts`` read them; all stays however many
    micro-batches there are.
    """
    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = None
        if batch_id:
            mark = spark.read.schema(_ACCOUNT).parquet(f"{path}/rows/batch={batch_id - 1}").first()["watermark"]
        passed = F.lit(mark).cast("timestamp_ntz")
        late = F.coalesce(F.col("end") <= passed, F.lit(False))
        timed = batch.withColumn("_t", F.col(ts).cast("timestamp"))
        counts, where = f"{path}/counts/batch={batch_id}", f"{path}/rows/batch={batch_id}"
        _windows(timed, width, by, F.max("_t").alias("newest")).withColumn("late", late).write.mode(
            "overwrite").parquet(counts)
        found = spark.read.parquet(counts)
        # F.window leaves out rows without a time.
        timeless = timed.filter("_t is null").agg(F.count(F.lit(1)).alias("rows_without_time"))
        seen = found.agg(F.coalesce(F.sum("found"), F.lit(0)).alias("timed"),
                         F.coalesce(F.sum(F.when(F.col("late"), F.col("found"))), F.lit(0)).alias("rows_late"),
                         F.greatest((F.max("newest") - F.expr(f"interval {delay}")).cast("timestamp_ntz"),
                                    passed).alias("watermark"))
        seen.crossJoin(timeless).select(
            (F.col("timed") + F.col("rows_without_time")).alias("rows_read"), "rows_late", "rows_without_time",
            "watermark").write.mode("overwrite").parquet(where)
        if spark.read.schema(_ACCOUNT).parquet(where).first()["rows_late"]:
            window = F.window("_t", width)["end"].cast("timestamp_ntz")
            timed.withColumn("_end", window).filter(F.col("_end") <= passed).drop("_t", "_end").write.mode(
                "overwrite").parquet(f"{path}/late/batch={batch_id}")

    return (
        events.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


_ACCOUNT = "rows_read long, rows_late long, rows_without_time long, watermark timestamp_ntz"


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    """One row over all micro-batches so far: rows read, rows late, rows without a time, watermark."""
    return spark.read.schema(_ACCOUNT).parquet(f"{path}/rows").agg(
        *[F.sum(c).alias(c) for c in ("rows_read", "rows_late", "rows_without_time")],
        F.max("watermark").alias("watermark"))


def read_closed_windows(spark: SparkSession, path: str, by: list[str] | None = None) -> DataFrame:
    """(start, end, by..., found) of the windows closed so far, without rows that came late."""
    closed = F.col("end") <= read_accounts(spark, path).select("watermark").scalar()
    return spark.read.parquet(f"{path}/counts").filter(~F.col("late")).filter(closed).groupBy(
        "start", "end", *(by or [])).agg(F.sum("found").alias("found"))


def rows_dropped_late(query: StreamingQuery) -> int:
    """Least number of rows that a finished stateful query left out behind its watermark.

    Spark counts them after its partial aggregation, so several late rows of one window and
    task count as one, and keeps the last updates of a query only; an update that is no
    longer kept raises an error.  ``publish_closed_windows`` counts all late rows.
    """
    progress = query.recentProgress
    kept = int(query._jsq.sparkSession().conf().get("spark.sql.streaming.numRecentProgressUpdates", "100"))
    if len(progress) >= kept - 1:  # Spark drops the oldest one when it has so many
        raise ValueError(f"updates before the last {len(progress)} may be lost: use publish_closed_windows")
    return sum(int(op["numRowsDroppedByWatermark"]) for p in progress for op in p["stateOperators"])


def late_rows(records: DataFrame, file_date: Column) -> DataFrame:
    """Per file date and publication date: rows, and whether they are out of the window."""
    published = F.to_date(utc_of_text(F.col("published_at")))
    return (
        records.groupBy(file_date.alias("file_date"), published.alias("published_date"))
        .agg(F.count(F.lit(1)).alias("row_cnt"))
        .withColumn(
            "out_of_window",
            F.coalesce(F.col("file_date") != F.col("published_date"), F.lit(True)),
        )
    )


def append_to_parquet(stream: DataFrame, path: str, checkpoint: str,
                      state_partitions: int | None = None) -> StreamingQuery:
    """Append a stream's output to a Parquet table, exactly once.

    A stateful query keeps the number of state partitions it is first started with;
    ``state_partitions`` sets it for this query alone (by default the session's number
    of shuffle partitions).
    """
    conf = stream.sparkSession.conf
    usual = conf.get("spark.sql.shuffle.partitions")
    conf.set("spark.sql.shuffle.partitions", str(state_partitions or usual))
    try:
        # The query takes its own copy of the settings when it starts.
        return (
            stream.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        conf.set("spark.sql.shuffle.partitions", usual)
