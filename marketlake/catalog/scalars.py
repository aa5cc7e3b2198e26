"""Scalar functions."""

from pyspark.sql import functions as F

from marketlake.catalog.base import VAC, events, query, table, vacancies
from marketlake.functions.lists import first_item, key_values, list_len
from marketlake.functions.times import (
    iso_with_offset,
    local_time,
    offset_minutes_of_text,
    parse_dump_time,
    utc_of_text,
    wall_clock_of_text,
)


@query("f1_utc_time", f"""with {VAC}
select url, (published_at::timestamptz at time zone 'UTC')::timestamp as published_at_utc from vac""")
def f1(spark, sf):
    return vacancies(spark, sf).select(
        "url", utc_of_text(F.col("published_at")).alias("published_at_utc"))


@query("f2_wall_clock", f"with {VAC} select url, published_at::timestamp as wall from vac")
def f2(spark, sf):
    return vacancies(spark, sf).select(
        "url", wall_clock_of_text(F.col("published_at")).alias("wall"))


@query("f3_offset_minutes", f"""with {VAC}
select url, date_diff('minute', (published_at::timestamptz at time zone 'UTC')::timestamp,
  published_at::timestamp)::smallint as published_at_offset from vac""")
def f3(spark, sf):
    return vacancies(spark, sf).select(
        "url", offset_minutes_of_text(F.col("published_at")).alias("published_at_offset"))


@query("f4_local_time", f"""with {VAC}
select url, published_at_utc + to_minutes(off_min) as published_at_local from vac""")
def f4(spark, sf):
    text = F.col("published_at")
    return vacancies(spark, sf).select(
        "url", local_time(utc_of_text(text), offset_minutes_of_text(text)).alias("published_at_local"))


@query("f5_date", "select event_id, cast(ts as date) as day from events")
def f5(spark, sf):
    return events(spark, sf).select("event_id", F.to_date("ts").alias("day"))


# Each order date written in one of the dump layouts, plus one that fits none.
_LAYOUTS = """select o_orderkey, o_orderdate, case o_orderkey % 6
  when 0 then strftime(o_orderdate, '%d.%m.%Y %H:%M') when 1 then strftime(o_orderdate, '%Y-%m-%d')
  when 2 then strftime(o_orderdate, '%d.%m.%Y') when 3 then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
  when 4 then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S+0500') else 'n/a' end as txt,
  o_orderkey % 6 as kind from orders"""


def _dump_dates(spark, sf):
    d = F.col("o_orderdate")
    kind = F.col("o_orderkey") % 6
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate",
        F.when(kind == 0, F.date_format(d, "dd.MM.yyyy HH:mm"))
        .when(kind == 1, F.date_format(d, "yyyy-MM-dd"))
        .when(kind == 2, F.date_format(d, "dd.MM.yyyy"))
        .when(kind == 3, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 4, F.concat(F.date_format(d, "yyyy-MM-dd HH:mm:ss"), F.lit("+0500")))
        .otherwise("n/a").alias("txt"),
        kind.alias("kind"),
    )


_KIND_LAYOUTS = ["dd.MM.yyyy HH:mm", "yyyy-MM-dd", "dd.MM.yyyy", "yyyy-MM-dd HH:mm:ss",
                 "yyyy-MM-dd HH:mm:ss[XXX][XX]", "yyyy-MM-dd"]


def _parsed(kind, txt):
    out = F.lit(None).cast("timestamp_ntz")
    for i, layout in enumerate(_KIND_LAYOUTS):
        out = F.when(kind == i, parse_dump_time(txt, layout)).otherwise(out)
    return out


@query("f6_parse_layouts", f"""select o_orderkey, case kind when 5 then null
  when 4 then o_orderdate - interval 5 hour
  else ((o_orderdate at time zone 'Europe/Moscow') at time zone 'UTC') end as parsed_utc
from ({_LAYOUTS})""")
def f6(spark, sf):
    return _dump_dates(spark, sf).select(
        "o_orderkey", _parsed(F.col("kind"), F.col("txt")).alias("parsed_utc"))


@query("f7_iso_moscow", f"""select o_orderkey, case when utc is null then null else
  strftime(msk, '%Y-%m-%dT%H:%M:%S') || '+' || lpad(cast(date_diff('hour', utc, msk) as varchar), 2, '0') || '00' end as iso
from (select *, (utc at time zone 'UTC') at time zone 'Europe/Moscow' as msk from (
  select o_orderkey, case kind when 5 then null when 4 then o_orderdate - interval 5 hour
    else ((o_orderdate at time zone 'Europe/Moscow') at time zone 'UTC') end as utc from ({_LAYOUTS})))""")
def f7(spark, sf):
    return _dump_dates(spark, sf).select(
        "o_orderkey", iso_with_offset(_parsed(F.col("kind"), F.col("txt"))).alias("iso"))


@query("f8_format", """select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S+0000') as text,
  strftime(ts, 'year=%Y/month=%m/day=%d') as part from events""")
def f8(spark, sf):
    return events(spark, sf).select(
        "event_id", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ssxx").alias("text"),
        F.date_format("ts", "'year='yyyy'/month='MM'/day='dd").alias("part"))


@query("f9_interval_arithmetic", """select event_id, ts + interval 1 second as next_second,
  make_timestamp(epoch_us(ts) // 2 * 2 + (epoch_us(timestamp '2024-02-01') - epoch_us(ts) // 2 * 2) // 2) as midpoint,
  least(ts + interval 60 minute, timestamp '2024-01-15') as stop from events""")
def f9(spark, sf):
    from marketlake.functions.times import micros, of_micros

    ts = F.col("ts")
    end = F.expr("timestamp_ntz'2024-02-01'")
    even = micros(ts) - micros(ts) % 2
    return events(spark, sf).select(
        "event_id", (ts + F.expr("interval 1 second")).alias("next_second"),
        of_micros(((even + micros(end)) / 2).cast("bigint")).alias("midpoint"),
        F.least(ts + F.expr("interval 60 minutes"), F.expr("timestamp_ntz'2024-01-15'")).alias("stop"))


@query("f10_rounding", """select event_id, cast(ceil(event_id / 100) as bigint) as pages,
  event_id // 7 as whole, cast(floor(value) as bigint) as down, round(event_id / 7, 2) as share from events""")
def f10(spark, sf):
    n = F.col("event_id")
    return events(spark, sf).select(
        "event_id", F.ceil(n / 100).alias("pages"), F.expr("event_id div 7").alias("whole"),
        F.floor("value").alias("down"), F.round(n / 7, 2).alias("share"))


@query("f11_list_length", f"""with {VAC}
select url, cast(len(work_format_ids) as bigint) as len from vac""")
def f11(spark, sf):
    return vacancies(spark, sf).select("url", list_len(F.col("work_format")).alias("len"))


@query("f12_first_element", f"with {VAC} select url, work_format_ids[1] as first_id, work_format_ids[2] as second_id from vac")
def f12(spark, sf):
    ids = F.col("work_format.id")
    return vacancies(spark, sf).select(
        "url", first_item(ids).alias("first_id"),
        F.try_element_at(ids, F.lit(2)).alias("second_id"))


@query("f13_flatten", f"with {VAC} select url, unnest(role_ids || coalesce(work_format_ids, [])) as item from vac")
def f13(spark, sf):
    lists = F.array("professional_roles.id", F.coalesce("work_format.id", F.array()))
    return vacancies(spark, sf).select("url", F.explode(F.flatten(lists)).alias("item"))


@query("f14_strings", """select c_custkey, c_name[10:18] as digits, cast(strpos(c_name, '#') as bigint) as hash_at,
  split_part(c_name, '#', 1) as kind, suffix(c_name, '7') as ends_7,
  replace(c_name, 'Customer', 'C') as short from customer""")
def f14(spark, sf):
    name = F.col("c_name")
    return table(spark, sf, "customer").select(
        "c_custkey", F.substring(name, 10, 9).alias("digits"),
        F.instr(name, "#").cast("bigint").alias("hash_at"),
        F.get(F.split(name, "#"), F.lit(0)).alias("kind"), name.endswith("7").alias("ends_7"),
        F.replace(name, F.lit("Customer"), F.lit("C")).alias("short"))


@query("f15_json", """select event_id, cast(props->>'$.k' as bigint) as k,
  '{"k":' || (props->>'$.k') || ',"note":null,"kind":"é ' || event_type || '"}' as encoded from events""")
def f15(spark, sf):
    rec = F.from_json("props", "k bigint")
    return events(spark, sf).withColumn("k", rec["k"]).select(
        "event_id", "k",
        F.to_json(F.struct("k", F.lit(None).cast("string").alias("note"),
                           F.concat(F.lit("é "), "event_type").alias("kind")),
                  {"ignoreNullFields": "false"}).alias("encoded"))


@query("f16_key_values", """select event_id, cast(year(ts) as varchar) as year,
  cast(month(ts) as varchar) as month, cast(day(ts) as varchar) as day from events""")
def f16(spark, sf):
    path = F.concat(F.lit("lake/year="), F.year("ts"), F.lit("/month="), F.month("ts"),
                    F.lit("/day="), F.day("ts"), F.lit("/part.parquet"))
    return events(spark, sf).withColumn("kv", key_values(path)).select(
        "event_id", *[F.col("kv")[k].alias(k) for k in ("year", "month", "day")])
