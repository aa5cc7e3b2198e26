"""Time-slice planning.  The caps are parameters set to fit the size of the tables."""

from pyspark.sql import functions as F

from marketlake.catalog.aggregates import n_rows
from marketlake.catalog.base import VAC, events, query, scratch_path, table, vacancies
from marketlake.functions.times import zone_day
from marketlake.operators.facets import filter_overlap
from marketlake.operators.slices import (
    SPAN_WALK,
    WalkRules,
    bisect_slices,
    chunk_windows,
    daily_second_counts,
    drill_slices,
    flag_beyond_cap,
    overlapping_slices,
    page_plan,
    rows_in_bisect_slices,
    rows_in_slices,
    walk_slices,
    weekly_second_counts,
    with_pages,
)
from marketlake.plans.harvest import ledger_over_cap, plan_days

DAY_CAP = 50

# Halving a day down to 337.5 s gives levels 0 to 8.
_BISECT = """nodes as (
  select date_trunc('day', ts)::timestamp as root, l as level,
    (epoch_us(ts) - epoch_us(date_trunc('day', ts)::timestamp)) * 256 // 86400000000 // cast(2 ** (8 - l) as bigint) as node,
    count(*) as found
  from events, (select unnest(range(0, 9)) as l) group by all),
slices as (
  select c.root, c.level, c.node, c.found, c.found > 50 as over_cap,
    make_timestamp(epoch_us(c.root) + cast(c.node * (86400000000 / 2 ** c.level) as bigint)) as "start",
    make_timestamp(epoch_us(c.root) + cast((c.node + 1) * (86400000000 / 2 ** c.level) as bigint)) as "end"
  from nodes c left join nodes p on p.root = c.root and p.level = c.level - 1 and p.node = c.node // 2
  where (c.level = 0 or p.found > 50) and (c.found <= 50 or c.level = 8))"""


@query("t1_bisect_slices", f"""with {_BISECT}
select root, cast(level as bigint) as level, node, found, over_cap, "start", "end" from slices""")
def t1(spark, sf):
    return bisect_slices(events(spark, sf), F.col("ts"), DAY_CAP)


@query("t1_rows_in_slices", f"""with {_BISECT}
select s.root, cast(s.level as bigint) as level, s.node, count(*) as row_cnt, min(event_id) as first_id, max(event_id) as last_id
from events e join slices s on e.ts >= s."start" and e.ts < s."end" group by all""")
def t1_rows(spark, sf):
    ev = events(spark, sf)
    rows = rows_in_bisect_slices(ev, F.col("ts"), bisect_slices(ev, F.col("ts"), DAY_CAP))
    return rows.groupBy("root", "level", "node").agg(
        n_rows("row_cnt"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


def _moscow_counts(ev):
    return daily_second_counts(ev, F.col("ts"))


# One recursion step tries one window of every run: shrink it, or take it and move on.
def _seconds_sql(unit):
    run = f"date_trunc('{unit}', msk)::date"
    return f"""m as (select (ts at time zone 'UTC') at time zone 'Europe/Moscow' as msk from events),
c as (select {run} as run, epoch_us(msk) // 1000000 - epoch_us({run}::timestamp) // 1000000 as s,
  count(*) as n from m group by all)"""


_SECONDS = _seconds_sql("day")


def _walk_sql(cap, min_step, reset, grow_below, grow_to, shrink="", unit="day", span=86400):
    return f"""with recursive {_seconds_sql(unit)},
w as (
  select run, 0::double as pos, 3600::double as step, -1::bigint as first_s, -1::bigint as last_s,
    0::bigint as found, false as taken from (select distinct run from c)
  union all
  select run, case when found > {cap} and step > {min_step} then pos else stop + 1 end,
    case when found > {cap} and step > {min_step} then step / 2
      when found > {cap} then {reset}
      when found < {grow_below} then {grow_to} {shrink} else step end,
    first_s, last_s, found, found > 0 and not (found > {cap} and step > {min_step})
  from (select w.run, pos, step, least(pos + step, {span}) as stop, floor(pos)::bigint as first_s,
      least(floor(least(pos + step, {span})), {span - 1})::bigint as last_s, coalesce(sum(n), 0)::bigint as found
    from w left join c on c.run = w.run and c.s between floor(w.pos) and least(floor(least(w.pos + w.step, {span})), {span - 1})
    where pos < {span} group by w.run, pos, step))
select run, epoch_us(run::timestamp) // 1000000 - 10800 + first_s as first_second,
  epoch_us(run::timestamp) // 1000000 - 10800 + last_s as last_second, found, found > {cap} as over_cap,
  make_timestamp(epoch_us(run::timestamp) - 10800000000 + first_s * 1000000) as "start",
  make_timestamp(epoch_us(run::timestamp) - 10800000000 + last_s * 1000000) as "end"
from w where taken"""


_OVERLAP = f"""with recursive {_SECONDS},
t as (
  select run, 0::double as lo, 86399::double as hi, sum(n)::bigint as found from c group by 1
  union all
  select k.run, k.lo, k.hi, coalesce(sum(c.n), 0)::bigint as found from (
    select run, unnest([lo, lo + half - over]) as lo, unnest([lo + half + over, hi]) as hi
    from (select *, (hi - lo) / 2 as half, least(300, (hi - lo) / 4) as over from t
          where found > {DAY_CAP} and (hi - lo) / 2 + least(300, (hi - lo) / 4) >= 300)) k
  left join c on c.run = k.run and c.s between floor(k.lo) and floor(k.hi)
  group by all)
select run, epoch_us(run::timestamp) // 1000000 - 10800 + floor(lo)::bigint as first_second,
  epoch_us(run::timestamp) // 1000000 - 10800 + floor(hi)::bigint as last_second, found, found > {DAY_CAP} as over_cap
from t where found > 0 and (found <= {DAY_CAP} or (hi - lo) / 2 + least(300, (hi - lo) / 4) < 300)"""


@query("t2_overlapping_slices", _OVERLAP)
def t2(spark, sf):
    return overlapping_slices(_moscow_counts(events(spark, sf)), cap=DAY_CAP).drop("start", "end")


@query("t2_overlap_deduplicated", f"""select count(*) as unique_cnt, sum(event_id)::bigint as id_sum,
  (select sum(found)::bigint from ({_OVERLAP})) as fetched_cnt,
  (select sum(found) from ({_OVERLAP})) > count(*) as repeats_seen from events""")
def t2_dedup(spark, sf):
    from marketlake.operators.dedup import keep_latest

    ev = events(spark, sf)
    slices = overlapping_slices(_moscow_counts(ev), cap=DAY_CAP)
    rows = rows_in_slices(ev.select("event_id", "ts"), F.col("ts"), zone_day(F.col("ts")), slices)
    fetched = rows.agg(n_rows("fetched")).scalar()
    unique = keep_latest(rows, ["event_id"], [F.col("first_second")]).agg(
        n_rows("unique_cnt"), F.sum("event_id").alias("id_sum"))
    return unique.select(
        "unique_cnt", "id_sum", fetched.alias("fetched_cnt"),
        (fetched > F.col("unique_cnt")).alias("repeats_seen"))


_DAY_GROWTH = "case when step < 86400 then step * 2 else step end"


@query("t3_adaptive_walk", _walk_sql(DAY_CAP, 60, 3600, 500, _DAY_GROWTH))
def t3(spark, sf):
    return plan_days(events(spark, sf), F.col("ts"), cap=DAY_CAP)


# With fewer rows a day than 500, a lower bound shows windows that stay as wide as they are.
@query("t3_steady_walk", _walk_sql(DAY_CAP, 60, 3600, 25, _DAY_GROWTH))
def t3_steady(spark, sf):
    return plan_days(events(spark, sf), F.col("ts"), cap=DAY_CAP, rules=WalkRules(grow_below=25))


@query("k7_window_ledger", f"""select run as day, count(*) as window_cnt, sum(found)::bigint as found
from ({_walk_sql(1, 60, 3600, 500, _DAY_GROWTH)}) where over_cap group by 1""")
def k7_windows(spark, sf):
    path = scratch_path(spark, "k7_windows")
    slices = plan_days(events(spark, sf), F.col("ts"), cap=1)
    for _ in range(2):  # a re-run replaces its own entries
        ledger_over_cap(slices, path, "2024-01")
    ledger = spark.read.schema("day date, found bigint").json(path)
    return ledger.groupBy("day").agg(n_rows("window_cnt"), F.sum("found").alias("found"))


SPAN_CAP = 2000


@query("t3_span_walk", _walk_sql(SPAN_CAP, 30, "step", 500, "least(step * 2, 604800)",
                                 "when found > 1500 then step * 0.8", "week", 604800))
def t3_span(spark, sf):
    counts = weekly_second_counts(events(spark, sf), F.col("ts"))
    return walk_slices(counts, cap=SPAN_CAP, rules=SPAN_WALK)


_MOSCOW_DAYS = """with m as (select cast((ts at time zone 'UTC') at time zone 'Europe/Moscow' as date) as run from events)
select run, count(*) as found, count(*) as row_cnt, true as within_cap from m group by 1"""


def _plan_against_rows(rows, ts, cap, zone="Europe/Moscow"):
    slices = plan_days(rows, ts, cap=cap, zone=zone)
    planned = slices.groupBy("run").agg(
        F.sum("found").alias("found"),
        F.bool_and((F.col("found") <= cap) | F.col("over_cap")).alias("within_cap"))
    met = rows_in_slices(rows, ts, zone_day(ts, zone), slices).groupBy("run").agg(n_rows("row_cnt"))
    return planned.join(met.withColumnRenamed("run", "_run"),
                        F.col("run").eqNullSafe(F.col("_run"))).drop("_run")


@query("t3_walk_invariant", _MOSCOW_DAYS)
def t3_invariant(spark, sf):
    return _plan_against_rows(events(spark, sf).select("ts"), F.col("ts"), DAY_CAP)


# Seven years of days in a zone whose days last 23, 24 or 25 hours; one key in 50 has no time.
@query("t3_days_of_any_length", """with o as (select case when o_orderkey % 50 <> 0 then
    o_orderdate + to_hours(cast(o_orderkey % 24 as int)) + to_minutes(cast(o_orderkey % 60 as int)) end as ts from orders)
select cast((ts at time zone 'UTC') at time zone 'Europe/Berlin' as date) as run, count(*) as found, count(*) as row_cnt,
  true as within_cap from o group by 1""")
def t3_any_length(spark, sf):
    ts = F.col("o_orderdate") + F.make_dt_interval(
        F.lit(0), (F.col("o_orderkey") % 24).cast("int"), (F.col("o_orderkey") % 60).cast("int"))
    rows = table(spark, sf, "orders").select(F.when(F.col("o_orderkey") % 50 != 0, ts).alias("ts"))
    return _plan_against_rows(rows, F.col("ts"), 3, "Europe/Berlin")


# Days over 330 rows are cut by event type, and types over 66 by user bucket.
@query("t4_drill_down", """with e as (select ts::date as day, nullif(event_type, 'error') as kind, user_id % 4 as bucket from events),
c as (select *, sum(n) over (partition by day) as n0, sum(n) over (partition by day, kind) as n1
  from (select day, kind, bucket, count(*) as n from e group by all)),
d as (select *, case when n0 <= 330 then 0 when n1 <= 330 then 1 else 2 end as depth from c)
select day, case when depth > 0 then kind end as kind, case when depth > 1 then bucket end as bucket,
  cast(depth as bigint) as depth, cast(sum(n) as bigint) as found, sum(n) > 330 as over_cap from d group by 1, 2, 3, 4""")
def t4(spark, sf):
    ev = events(spark, sf).withColumn("day", F.to_date("ts"))
    return drill_slices(ev, ["day"], {
        "kind": F.expr("nullif(event_type, 'error')"), "bucket": F.col("user_id") % 4}, 330)


@query("t4_drill_deep", """with e as (select ts::date as day, nullif(event_type, 'error') as kind, user_id % 4 as bucket from events),
c as (select *, sum(n) over (partition by day) as n0, sum(n) over (partition by day, kind) as n1
  from (select day, kind, bucket, count(*) as n from e group by all)),
d as (select *, case when n0 <= 66 then 0 when n1 <= 66 then 1 else 2 end as depth from c)
select day, case when depth > 0 then kind end as kind, case when depth > 1 then bucket end as bucket,
  cast(depth as bigint) as depth, cast(sum(n) as bigint) as found, sum(n) > 66 as over_cap from d group by 1, 2, 3, 4""")
def t4_deep(spark, sf):
    ev = events(spark, sf).withColumn("day", F.to_date("ts"))
    return drill_slices(ev, ["day"], {
        "kind": F.expr("nullif(event_type, 'error')"), "bucket": F.col("user_id") % 4}, 66)


@query("t5_hard_cap", """select ts::date as day, event_id, count(*) over (partition by ts::date) as found,
  row_number() over (partition by ts::date order by epoch_us(ts) // 1000000, md5(event_id::varchar), event_id) > 300 as beyond_cap
from events""")
def t5(spark, sf):
    ev = events(spark, sf).select(F.to_date("ts").alias("day"), "ts", "event_id")
    return flag_beyond_cap(ev, ["day"], 300, F.col("ts"), F.col("event_id")).drop("ts")


@query("t6_page_fan_out", """select day, (rn - 1) // 100 as page, count(*) as row_cnt, cast(sum(event_id) as bigint) as id_sum from (
  select ts::date as day, event_id, row_number() over (partition by ts::date
    order by epoch_us(ts) // 1000000, md5(event_id::varchar), event_id) as rn from events) group by all""")
def t6(spark, sf):
    ev = events(spark, sf).select(F.to_date("ts").alias("day"), "ts", "event_id")
    return with_pages(ev, ["day"], F.col("ts"), F.col("event_id")).groupBy("day", "page").agg(
        n_rows("row_cnt"), F.sum("event_id").alias("id_sum"))


@query("t6_hot_group_pages", """select event_type, (rn - 1) // 100 as page, count(*) as row_cnt, cast(sum(event_id) as bigint) as id_sum from (
  select event_type, event_id, row_number() over (partition by event_type
    order by epoch_us(date_trunc('day', ts)::timestamp) // 1000000, md5(event_id::varchar), event_id) as rn from events) group by all""")
def t6_hot(spark, sf):
    ev = events(spark, sf).select("event_type", F.date_trunc("day", "ts").alias("d"), "event_id")
    return with_pages(ev, ["event_type"], F.col("d"), F.col("event_id"), hot_rows=500).groupBy(
        "event_type", "page").agg(n_rows("row_cnt"), F.sum("event_id").alias("id_sum"))


@query("t6_page_plan", """select day, found, pages, unnest(range(0, pages)) as page from (
  select ts::date as day, count(*) as found, cast(ceil(count(*) / 100) as bigint) as pages
  from events group by 1)""")
def t6_plan(spark, sf):
    found = events(spark, sf).groupBy(F.to_date("ts").alias("day")).agg(n_rows("found"))
    return page_plan(found)


@query("t7_chunks", """with s as (select min(o_orderdate) as lo, max(o_orderdate) as hi from orders)
select i as chunk, lo + to_days(cast(30 * i as int)) as "start", least(lo + to_days(cast(30 * (i + 1) as int)), hi + interval 1 microsecond) as "end"
from s, (select unnest(range(0, 2000)) as i) where lo + to_days(cast(30 * i as int)) <= hi""")
def t7(spark, sf):
    return chunk_windows(table(spark, sf, "orders"), F.col("o_orderdate"))


@query("t8_filter_overlap", f"""with {VAC}
select filter_value, count(*) as total_cnt, count(distinct id) as unique_cnt
from (select unnest(work_format_ids) as filter_value, id from vac) group by 1""")
def t8(spark, sf):
    return filter_overlap(vacancies(spark, sf), F.col("work_format.id"), "id")
