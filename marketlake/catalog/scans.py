"""Sources and sinks."""

from pyspark.sql import functions as F

from marketlake.catalog.base import (
    VAC,
    bronze,
    damaged_bronze,
    events,
    query,
    scratch_path,
    table,
    written,
)
from marketlake.functions.times import in_zone, previous_day, zone_day
from marketlake.operators.series import date_spine
from marketlake.sinks.writers import (
    as_view,
    overwrite_days,
    with_day_keys,
    write_jsonl_batches,
    write_ledger,
    write_parquet,
)
from marketlake.sources.dumps import scan_dump
from marketlake.sources.jsonl import quarantine, scan_jsonl, scan_jsonl_inferred, scan_lines
from marketlake.sources.tables import (
    file_inventory,
    path_date,
    path_parts_date,
    scan_day,
    scan_partitioned,
)


def event_days(spark, sf):
    """Events written as year=/month=/day= Parquet."""
    return written(
        spark, sf, "event_days",
        lambda path: overwrite_days(with_day_keys(events(spark, sf), "ts"), path),
    )


@query("s1_jsonl_scan", f"""with {VAC}
select id, name, url, published_at, salary_from, salary_to, area_name, internship,
  cast(len(role_ids) as bigint) as role_cnt, role_ids[1] as first_role from vac""")
def s1(spark, sf):
    rec = scan_jsonl(spark, bronze(spark, sf))
    return rec.select(
        "id", "name", "url", "published_at", F.col("salary.from").alias("salary_from"),
        F.col("salary.to").alias("salary_to"), F.col("area.name").alias("area_name"),
        "internship", F.array_size("professional_roles").cast("bigint").alias("role_cnt"),
        F.get("professional_roles", F.lit(0))["id"].alias("first_role"),
    )


@query("s2_jsonl_inferred",
       "select cast(props->>'$.k' as bigint) as k, count(*) as cnt from events group by 1")
def s2(spark, sf):
    path = written(spark, sf, "props", lambda p: events(spark, sf).select(
        F.col("props").alias("value")).write.option("compression", "gzip").text(p))
    return scan_jsonl_inferred(spark, path).groupBy("k").agg(F.count(F.lit(1)).alias("cnt"))


@query("s3_tolerant_scan", f"""with {VAC}
select cast(event_id % 10 in (0, 1) as int) = 0 as has_id, count(*) as line_cnt,
  count_if(event_id % 10 not in (0, 2))::bigint as internship_cnt,
  count_if(schedule_id is not null and event_id % 10 not in (0, 3))::bigint as schedule_cnt
from vac group by 1""")
def s3(spark, sf):
    rec = scan_jsonl(spark, damaged_bronze(spark, sf))
    return rec.groupBy(F.col("id").isNotNull().alias("has_id")).agg(
        F.count(F.lit(1)).alias("line_cnt"), F.count("internship").alias("internship_cnt"),
        F.count("schedule").alias("schedule_cnt"),
    )


@query("s4_partitioned_scan", """select cast(year(ts) as bigint) as year,
  cast(month(ts) as bigint) as month, cast(day(ts) as bigint) as day, count(*) as row_cnt,
  count(distinct user_id) as id_cnt from events group by all""")
def s4(spark, sf):
    return scan_partitioned(spark, event_days(spark, sf)).groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("row_cnt"), F.count_distinct("user_id").alias("id_cnt")
    )


@query("s5_one_day_scan", "select * from events where cast(ts as date) = date '2024-01-10'")
def s5(spark, sf):
    return scan_day(spark, event_days(spark, sf), 2024, 1, 10)


@query("s6_dump_scan", """select cast(c_custkey as varchar) as c_custkey, c_name || ';' as c_name,
  nullif(c_mktsegment, 'BUILDING') as c_mktsegment from customer""")
def s6(spark, sf):
    cust = table(spark, sf, "customer").select(
        "c_custkey", F.concat("c_name", F.lit(";")).alias("c_name"),
        F.expr("nullif(c_mktsegment, 'BUILDING')").alias("c_mktsegment"),
    )
    path = written(spark, sf, "customer_csv",
                   lambda p: cust.write.option("sep", ";").option("header", True).csv(p))
    return scan_dump(spark, path, ";")


@query("s7_file_inventory", """select ts::date as day, count(*) as row_cnt, true as has_size
from events group by 1""")
def s7(spark, sf):
    files = file_inventory(spark.read.parquet(event_days(spark, sf)))
    return files.groupBy(path_parts_date(F.col("file_path")).alias("day")).agg(
        F.sum("row_cnt").alias("row_cnt"), F.bool_and(F.col("file_size") > 0).alias("has_size"))


@query("s8_path_dates", """select cast(ts as date) as file_date, cast(ts as date) as parts_date,
  count(*) as row_cnt from events group by all""")
def s8(spark, sf):
    by_date = scan_lines(spark, bronze(spark, sf)).groupBy(
        path_date(F.col("file_path")).alias("file_date")
    ).agg(F.count(F.lit(1)).alias("row_cnt"))
    by_parts = spark.read.parquet(event_days(spark, sf)).select(
        path_parts_date(F.col("_metadata.file_path")).alias("parts_date")
    ).distinct()
    return by_date.join(by_parts, by_date.file_date == by_parts.parts_date)


@query("s10_date_spine", """select cast(d as date) as day, row_number() over (order by d) - 1 as idx
from (select unnest(generate_series(max(ts)::date - 89, max(ts)::date, interval 1 day)) as d
      from events)""")
def s10(spark, sf):
    return date_spine(events(spark, sf), F.col("ts"), 90)


@query("s11_moscow_days", """with m as (select *,
  (ts at time zone 'UTC') at time zone 'Europe/Moscow' as msk from events)
select cast(msk as date) as run_date, count(*) as row_cnt, min(msk) as first_at, max(msk) as last_at,
  cast(date_trunc('day', min(msk)) as timestamp) - interval 27 hour as prev_start,
  cast(date_trunc('day', min(msk)) as timestamp) - interval 3 hour as prev_end
from m group by 1""")
def s11(spark, sf):
    msk = in_zone(F.col("ts"))
    start, end = previous_day(F.min("ts"))
    return events(spark, sf).groupBy(zone_day(F.col("ts")).alias("run_date")).agg(
        F.count(F.lit(1)).alias("row_cnt"), F.min(msk).alias("first_at"),
        F.max(msk).alias("last_at"), start.alias("prev_start"), end.alias("prev_end"),
    )


# ---- sinks ------------------------------------------------------------------

@query("k1_parquet_zstd", "select * from events")
def k1(spark, sf):
    path = scratch_path(spark, "k1")
    write_parquet(events(spark, sf), path, row_group_bytes=32 * 1024 * 1024)
    return spark.read.parquet(path)


@query("k2_parquet_level", "select * from orders")
def k2(spark, sf):
    path = scratch_path(spark, "k2")
    write_parquet(table(spark, sf, "orders"), path, level=15)
    return spark.read.parquet(path)


@query("k3_jsonl_batches", """select count(*) as row_cnt, count(distinct event_id) as id_cnt,
  true as within_cap from events""")
def k3(spark, sf):
    path = scratch_path(spark, "k3")
    write_jsonl_batches(events(spark, sf), path, rows_per_file=10_000)
    back = spark.read.schema(events(spark, sf).schema).json(path)
    per_file = back.groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("d"))
    return per_file.agg(F.sum("n").alias("row_cnt"), F.sum("d").alias("id_cnt"),
                        (F.max("n") <= 10_000).alias("within_cap"))


@query("k4_rerun_day", """select cast(ts as date) as day, count(*) as row_cnt,
  count(distinct event_id) as id_cnt from events group by 1""")
def k4(spark, sf):
    path = scratch_path(spark, "k4")
    days = with_day_keys(events(spark, sf), "ts")
    overwrite_days(days, path)
    overwrite_days(days.filter("day between 3 and 5"), path)
    return spark.read.parquet(path).groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("row_cnt"), F.count_distinct("event_id").alias("id_cnt"))


@query("k5_publish_day_layout", f"""with {VAC}
select cast(year(published_at_utc) as bigint) as year, cast(month(published_at_utc) as bigint) as month,
  cast(day(published_at_utc) as bigint) as day, count(*) as row_cnt from vac group by all""")
def k5(spark, sf):
    from marketlake.plans.silver import with_utc_and_offset

    path = scratch_path(spark, "k5")
    rows = with_utc_and_offset(scan_jsonl(spark, bronze(spark, sf)))
    overwrite_days(with_day_keys(rows.select("id", "published_at_utc"), "published_at_utc"), path)
    return scan_partitioned(spark, path).groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("row_cnt"))


@query("k6_empty_batch", "select count(*) as row_cnt from events")
def k6(spark, sf):
    path = scratch_path(spark, "k6")
    days = with_day_keys(events(spark, sf), "ts")
    overwrite_days(days, path)
    overwrite_days(days.filter("ts is null"), path)  # a run without rows replaces nothing
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_cnt"))


@query("k7_quarantine_ledger", """select case event_id % 10 when 0 then 'broken_line'
    when 1 then 'no_key' else 'bad_field' end as reason, count(*) as line_cnt
from events where event_id % 10 in (0, 1, 2) or (event_id % 10 = 3 and event_id % 4 <> 3)
group by 1""")
def k7(spark, sf):
    path = scratch_path(spark, "k7")
    for _ in range(2):  # a re-run replaces its own entries
        write_ledger(quarantine(scan_lines(spark, damaged_bronze(spark, sf))), path, "2024-01")
    ledger = spark.read.schema("value string, file_path string, reason string").json(path)
    return ledger.groupBy("reason").agg(F.count("value").alias("line_cnt"))


@query("k8_view", "select event_type, count(*) as cnt from events group by 1")
def k8(spark, sf):
    as_view(scan_partitioned(spark, event_days(spark, sf)), "event_days")
    return spark.sql("select event_type, count(*) as cnt from event_days group by 1")
