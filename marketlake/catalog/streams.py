"""Incremental jobs run to completion over the derived files."""

from pyspark.sql import functions as F

from marketlake.catalog.base import SQL, VAC, bronze, damaged_bronze, events, query, scratch_path, vacancies
from marketlake.catalog.jobs import _DAYS, _FLAT, TIES, dated_records, flat_silver
from marketlake.sources.jsonl import scan_jsonl_stream, scan_lines_stream
from marketlake.sources.tables import scan_partitioned
from marketlake.streaming.ingest import (
    late_rows,
    publish_closed_windows,
    publish_first_seen,
    publish_window_counts,
    read_accounts,
    read_closed_windows,
    read_window_counts,
    stream_run,
    stream_to_silver,
)
from marketlake.streaming.state import (
    open_windows,
    publish_first_rows,
    publish_watermarked_windows,
    published_windows,
)


def _finish(stream_query):
    stream_query.awaitTermination()
    if stream_query.exception():
        raise stream_query.exception()


@query("r1_stream_to_silver", f"""with {VAC}
select {_FLAT}, {_DAYS} from vac qualify row_number() over
  (partition by id, cast(published_at_utc as date) order by published_at_utc desc, url) = 1""")
def r1(spark, sf):
    path = scratch_path(spark, "r1")
    records = scan_jsonl_stream(spark, bronze(spark, sf), max_files=15)
    _finish(stream_to_silver(records, path, scratch_path(spark, "r1_state"), TIES))
    return _silver_with_days(spark, path)


def _silver_with_days(spark, path):
    rows = scan_partitioned(spark, path)
    # Spark judges this side by its compressed files (1.5 MB for 380 MB of rows), so it would
    # broadcast it, and the driver would gather a row for every row of silver.
    days = rows.select("url", "year", "month", "day").hint("merge")
    return flat_silver(rows).join(days, "url")


@query("r1_logged_run", SQL["r1_stream_to_silver"])
def r1_logged(spark, sf):
    """The same rows with micro-batches logged, one merge at the end and the ledger of the run."""
    path = scratch_path(spark, "r1_logged")
    lines = scan_lines_stream(spark, bronze(spark, sf), max_files=15)
    stream_run(lines, path, *[scratch_path(spark, f"r1_{part}") for part in ("ledger", "log", "state")], TIES)
    return _silver_with_days(spark, path)


@query("r1_ledger", f"""{SQL["k7_quarantine_ledger"]}
union all select 'lines_read', count(*) from events
union all select 'new column extra', count(*) from events where event_id % 3 = 0 and event_id % 10 <> 0""")
def r1_ledger(spark, sf):
    """What the stream says about damaged lines, over several micro-batches and two runs."""
    places = [scratch_path(spark, f"r1_{part}") for part in ("damaged", "bad_ledger", "bad_log", "bad_state")]
    for _ in range(2):  # the second run finds no new files
        stream_run(scan_lines_stream(spark, damaged_bronze(spark, sf), max_files=15), *places, TIES)
    reasons = spark.read.schema("reason string").json(f"{places[1]}/quarantine")
    metrics = spark.read.schema("lines_read bigint").json(f"{places[1]}/metrics")
    drift = spark.read.schema("column string, status string, line_cnt bigint").json(f"{places[1]}/drift")
    return (
        reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("line_cnt"))
        .unionByName(metrics.select(F.lit("lines_read").alias("reason"), F.col("lines_read").alias("line_cnt")))
        .unionByName(drift.filter("status = 'new'").select(
            F.concat(F.lit("new column "), "column").alias("reason"), "line_cnt"))
    )


@query("r2_first_seen", f"with {VAC} select distinct id from vac")
def r2(spark, sf):
    path = scratch_path(spark, "r2")
    records = scan_jsonl_stream(spark, bronze(spark, sf), max_files=15)
    _finish(publish_first_seen(records, path, scratch_path(spark, "r2_state")))
    return spark.read.parquet(path).select("id")


@query("r3_window_counts", """with w as (select date_trunc('hour', ts)::timestamp as "start",
  event_type, count(*) as found from events group by all)
select "start", "start" + interval 1 hour as "end", event_type, found from w""")
def r3(spark, sf):
    path = scratch_path(spark, "r3")
    schema = events(spark, sf).schema
    stream = spark.readStream.schema(schema).parquet(f"{sf}/event[s].parquet")
    _finish(publish_window_counts(stream, "ts", "1 hour", path, scratch_path(spark, "r3_state"), ["event_type"]))
    return read_window_counts(spark, path, ["event_type"])


@query("r3_rows_accounted", """select count(*) as row_cnt, true as accounted from events""")
def r3_accounted(spark, sf):
    """A watermarked count: rows emitted, rows in windows still open and rows dropped add up."""
    path = scratch_path(spark, "r3_closed")
    schema = events(spark, sf).schema
    stream = spark.readStream.schema(schema).parquet(f"{sf}/event[s].parquet")
    _finish(publish_closed_windows(stream, "ts", "1 hour", "1 hour", path, scratch_path(spark, "r3_closed_state"),
                                   ["event_type"]))
    closed = read_closed_windows(spark, path, ["event_type"])
    accounts = read_accounts(spark, path)
    ev = events(spark, sf)
    still_open = ev.filter(F.date_trunc("hour", "ts").cast("timestamp_ntz") + F.expr("interval 1 hour")
                           > ev.agg(F.max("ts") - F.expr("interval 1 hour")).scalar())
    return ev.agg(F.count(F.lit(1)).alias("row_cnt")).select("row_cnt", (
        F.col("row_cnt") == closed.agg(F.coalesce(F.sum("found"), F.lit(0))).scalar()
        + still_open.agg(F.count(F.lit(1))).scalar()
        + accounts.select(F.col("rows_late") + F.col("rows_without_time")).scalar()).alias("accounted"))


@query("r4_late_rows", f"""with {VAC}
select cast(ts as date) as file_date, cast(published_at_utc as date) as published_date, count(*) as row_cnt,
  cast(ts as date) <> cast(published_at_utc as date) as out_of_window from vac group by all""")
def r4(spark, sf):
    return late_rows(dated_records(spark, sf), F.col("date"))


@query("r2_first_rows", f"""with {VAC} select id, 1::bigint as row_cnt, true as is_source_row
from vac group by id""")
def r2_rows(spark, sf):
    """One whole row an id, with the seen ids in Spark's state; whether it is a row of the input."""
    path = scratch_path(spark, "r2_rows")
    records = scan_jsonl_stream(spark, bronze(spark, sf), max_files=15)
    _finish(publish_first_rows(records, path, scratch_path(spark, "r2_rows_state"), state_partitions=8))
    fields = [F.col(c) for c in ("id", "name", "published_at", "salary", "schedule", "employer.name")]
    first = spark.read.parquet(path).select("id", "url", F.to_json(F.struct(*fields)).alias("own"))
    source = vacancies(spark, sf).select("url", F.to_json(F.struct(*fields)).alias("row"))
    return first.join(source, "url", "left").groupBy("id").agg(
        F.count(F.lit(1)).alias("row_cnt"), F.bool_and(F.col("own").eqNullSafe(F.col("row"))).alias("is_source_row"))


# Events come in thirds of their days; a tenth of them a third later, so some come after their window closed.
_THIRDS, _DELAY_HOURS = 3, 24


@query("r3_watermarked_windows", f"""with e as (select *, (datediff('day', (select min(ts) from events), ts) * {_THIRDS}
   // ((select datediff('day', min(ts), max(ts)) from events) + 1)) + (event_id % 10 = 0)::int as slice from events),
marks as (select slice, max(epoch_ms(ts)) as newest from e group by slice),
w as (select date_trunc('day', ts)::timestamp + interval 1 day as "end", event_type, slice,
  epoch_ms(date_trunc('day', ts)::timestamp + interval 1 day) as end_ms from e),
m as (select w.*, (select max(newest) from marks where marks.slice < w.slice) - {_DELAY_HOURS} * 3600000 as mark,
  (select max(newest) from marks) - {_DELAY_HOURS} * 3600000 as last from w)
select "end", event_type, count(*) filter (where end_ms > coalesce(mark, 0) and end_ms <= last) as closed,
 count(*) filter (where end_ms > coalesce(mark, 0) and end_ms > last) as open,
 count(*) filter (where end_ms <= mark) as late
from m group by all""")
def r3_watermarked(spark, sf):
    """Rows of every window by what became of them, over several runs of one stream with late rows."""
    base, path, state = (scratch_path(spark, f"r3_{x}") for x in ("in", "out", "state"))
    ev = events(spark, sf)
    ends = ev.agg(F.min("ts").alias("low"), F.max("ts").alias("high"))
    days = F.datediff("ts", "low") * _THIRDS / (F.datediff("high", "low") + 1)
    sliced = ev.join(F.broadcast(ends)).withColumn("slice", F.floor(days) + (F.col("event_id") % 10 == 0).cast("int"))
    for k in range(_THIRDS + 1):
        sliced.filter(F.col("slice") == k).select(*ev.columns).write.mode("append").parquet(base)
        stream = spark.readStream.schema(ev.schema).parquet(base)
        _finish(publish_watermarked_windows(stream, "ts", "1 day", f"{_DELAY_HOURS} hours", path, state,
                                            ["event_type"], state_partitions=8))
    by = ["end", "event_type"]
    return published_windows(spark, path, ["event_type"]).join(
        open_windows(spark, state, ["event_type"]), by, "full").select(
        *by, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("closed", "open", "late")])
