"""End-to-end jobs."""

from pyspark.sql import functions as F

from marketlake.catalog.aggregates import n_rows
from marketlake.catalog.base import (
    VAC,
    bronze,
    damaged_bronze,
    events,
    query,
    scratch_path,
    table,
    vacancies,
    written,
)
from marketlake.functions.lists import first_item
from marketlake.plans.harvest import batch_rows
from marketlake.plans.historical import Dump, canonical_dumps, consolidate, left_out
from marketlake.plans.marts import top_terms
from marketlake.operators.profile import list_reports
from marketlake.plans.profile import LIST_REPORTS, profile_silver
from marketlake.plans.reconcile import copies_of_top_key, repeats_by_date
from marketlake.plans.silver import bronze_to_silver, clean_any, enrich, silver_run
from marketlake.sinks.writers import write_jsonl_batches, write_parquet
from marketlake.sources.jsonl import scan_jsonl
from marketlake.sources.tables import scan_partitioned

TIES = ["url"]


def flat_silver(silver):
    """Scalar columns of silver rows."""
    return silver.select(
        "id", "name", "url", "published_at_utc", "created_at_utc", "published_at_offset",
        "created_at_offset", "internship", F.col("salary.from").alias("salary_from"),
        F.col("salary.to").alias("salary_to"), F.col("area.name").alias("area_name"),
        F.array_join("professional_roles.id", ",").alias("roles"),
        F.size("work_format").cast("bigint").alias("format_cnt"),
    )


_FLAT = """id, name, url, published_at_utc, created_at_utc, cast(off_min as smallint) as published_at_offset,
  cast(off_min as smallint) as created_at_offset, internship, salary_from, salary_to, area_name,
  array_to_string(role_ids, ',') as roles, cast(len(work_format_ids) as bigint) as format_cnt"""
_DAYS = """cast(year(published_at_utc) as bigint) as year, cast(month(published_at_utc) as bigint) as month,
  cast(day(published_at_utc) as bigint) as day"""


def silver(spark, sf):
    return written(spark, sf, "silver",
                   lambda p: bronze_to_silver(spark, bronze(spark, sf), p, TIES))


@query("c1_bronze_to_silver", f"""with {VAC}
select {_FLAT}, {_DAYS} from vac
qualify row_number() over (partition by id order by published_at_utc desc, url) = 1""")
def c1(spark, sf):
    path = scratch_path(spark, "c1")
    bronze_to_silver(spark, bronze(spark, sf), path, TIES)
    rows = scan_partitioned(spark, path)
    days = rows.select("url", "year", "month", "day")
    return flat_silver(rows).join(days, "url")


@query("c1_damaged_input", f"""with {VAC}, d as (select * replace (
    case when event_id % 10 = 2 then null else internship end as internship) from vac
  where event_id % 10 not in (0, 1))
select {_FLAT} from d
qualify row_number() over (partition by id order by published_at_utc desc, url) = 1""")
def c1_damaged(spark, sf):
    path = scratch_path(spark, "c1_damaged")
    bronze_to_silver(spark, damaged_bronze(spark, sf), path, TIES)
    return flat_silver(scan_partitioned(spark, path))


@query("c1_whole_job", f"""with {VAC}, d as (select * from vac where event_id % 10 not in (0, 1))
select 'lines_read' as entry, count(*) as cnt from events
union all select 'lines_kept', count(*) from d
union all select 'broken_line', count(*) from events where event_id % 10 = 0
union all select 'no_key', count(*) from events where event_id % 10 = 1
union all select 'bad_field', count(*) from events where event_id % 10 = 2 or (event_id % 10 = 3 and event_id % 4 <> 3)
union all select 'silver_rows', count(distinct id) from d
union all select 'new column extra', count(*) from events where event_id % 3 = 0 and event_id % 10 <> 0""")
def c1_whole(spark, sf):
    """The daily job on damaged lines, run twice, with its ledger."""
    path, ledger = scratch_path(spark, "c1_whole"), scratch_path(spark, "c1_ledger")
    for _ in range(2):
        silver_run(spark, damaged_bronze(spark, sf), path, ledger, "2024-01", TIES)
    metrics = spark.read.schema("lines_read bigint, lines_kept bigint").json(f"{ledger}/metrics")
    reasons = spark.read.schema("reason string").json(f"{ledger}/quarantine")
    drift = spark.read.schema("column string, status string, line_cnt bigint").json(f"{ledger}/drift")
    return (
        metrics.selectExpr("stack(2, 'lines_read', lines_read, 'lines_kept', lines_kept) as (entry, cnt)")
        .unionByName(reasons.groupBy(F.col("reason").alias("entry")).agg(n_rows("cnt")))
        .unionByName(scan_partitioned(spark, path).agg(n_rows("cnt")).withColumn("entry", F.lit("silver_rows")))
        .unionByName(drift.filter("status = 'new'").select(
            F.concat(F.lit("new column "), "column").alias("entry"), F.col("line_cnt").alias("cnt")))
    )


@query("c1_daily_batches", f"""with {VAC}, m as (select d as split from (select d, row_number() over (order by d) - 1 as k, count(*) over () as n
  from (select distinct cast(ts as date) as d from events)) where k = n // 2),
b as (select vac.* from vac, m
  qualify row_number() over (partition by id, cast(ts as date) >= m.split order by published_at_utc desc, url) = 1)
select {_FLAT} from b
qualify row_number() over (partition by id, cast(published_at_utc as date) order by published_at_utc desc, url) = 1""")
def c1_batches(spark, sf):
    """All files in two batches, the second run twice; late rows merge into days of the first."""
    path, source = scratch_path(spark, "c1_batches"), bronze(spark, sf)
    days = [f"{r['date']:%Y-%m-%d}" for r in spark.read.text(source).select("date").distinct().orderBy("date").collect()]
    middle = len(days) // 2
    for batch in (days[:middle], days[middle:], days[middle:]):
        bronze_to_silver(spark, f"{source}/date={{{','.join(batch)}}}", path, TIES)
    return flat_silver(scan_partitioned(spark, path))


@query("c2_any_version", f"""with {VAC}
select count(*) as row_cnt, count(distinct id) as id_cnt from (select distinct id from vac)""")
def c2(spark, sf):
    rows = clean_any(scan_jsonl(spark, bronze(spark, sf)))
    return rows.agg(n_rows("row_cnt"), F.count_distinct("id").alias("id_cnt"))


JOB_DUMPS = [
    Dump("items.csv", ";", "dd.MM.yyyy HH:mm",
         {"vacancy_id": "id_vac", "vacancy_name": "name", "date_published": "published_at",
          "salary_from": "salary"}),
    Dump("orders.csv", ",", "yyyy-MM-dd HH:mm:ss[XXX][XX]",
         {"vacancy_id": "id", "vacancy_name": "title", "date_published": "created_at"}),
    Dump("customers.csv", "|", "yyyy-MM-dd",
         {"vacancy_name": "positionName", "date_published": "publishedDate"}),
    Dump("suppliers.csv", ";", "yyyy-MM-dd HH:mm:ss",
         {"vacancy_id": "id", "date_published": "last_found_at", "salary_from": "salary_from",
          "data_source": "data_source"}),
]


def _write_dumps(spark, sf):
    def write(folder):
        frames = {
            "items.csv": (";", table(spark, sf, "lineitem").select(
                F.col("l_orderkey").alias("id_vac"),
                F.concat("l_returnflag", F.lit('; "'), "l_linestatus", F.lit('"')).alias("name"),
                F.date_format("l_shipdate", "dd.MM.yyyy HH:mm").alias("published_at"),
                F.col("l_quantity").cast("bigint").alias("salary"))),
            "orders.csv": (",", table(spark, sf, "orders").select(
                F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("title"),
                F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit("+0500"))
                .alias("created_at"))),
            "customers.csv": ("|", table(spark, sf, "customer").select(
                F.col("c_name").alias("positionName"), F.lit("2022-06-01").alias("publishedDate"))),
            "suppliers.csv": (";", table(spark, sf, "supplier").select(
                F.col("s_suppkey").alias("id"), F.lit("2022-06-01 10:00:00").alias("last_found_at"),
                F.col("s_nationkey").alias("salary_from"), F.lit("sup").alias("data_source"))),
        }
        for name, (sep, df) in frames.items():
            df.write.option("sep", sep).option("header", True).option("escape", '"').csv(
                f"{folder}/{name}")

    return write


_DUMPS_SQL = """with d as (
  select l_orderkey::varchar as vacancy_id, l_returnflag || '; "' || l_linestatus || '"' as vacancy_name,
    (l_shipdate at time zone 'Europe/Moscow') at time zone 'UTC' as utc, cast(l_quantity as bigint)::varchar as salary_from,
    'hh' as data_source, 'items.csv' as file_source from lineitem
  union all select o_orderkey::varchar, o_orderpriority, o_orderdate - interval 5 hour, null, 'hh', 'orders.csv' from orders
  union all select '~' || md5(c_name || chr(31) || '2022-06-01'), c_name, timestamp '2022-05-31 21:00:00', null, 'hh', 'customers.csv' from customer
  union all select s_suppkey::varchar, null, timestamp '2022-06-01 07:00:00', s_nationkey::varchar, 'sup', 'suppliers.csv' from supplier)
select vacancy_id, vacancy_name, strftime(msk, '%Y-%m-%dT%H:%M:%S') || '+' || lpad(cast(date_diff('hour', utc, msk) as varchar), 2, '0') || '00' as date_published,
  salary_from, data_source, file_source
from (select *, (utc at time zone 'UTC') at time zone 'Europe/Moscow' as msk from d)
{where}
qualify row_number() over (partition by vacancy_id, data_source order by utc desc, vacancy_name nulls first, salary_from nulls first, file_source) = 1"""


@query("c3_consolidate_dumps", _DUMPS_SQL.format(where=""))
def c3(spark, sf):
    folder = written(spark, sf, "dumps", _write_dumps(spark, sf))
    path = scratch_path(spark, "c3")
    write_parquet(consolidate(spark, folder, JOB_DUMPS), path, level=15)
    return spark.read.parquet(path)


@query("c3_strict_names", _DUMPS_SQL.format(where="where vacancy_name is not null"))
def c3_strict(spark, sf):
    folder = written(spark, sf, "dumps", _write_dumps(spark, sf))
    return consolidate(spark, folder, JOB_DUMPS, ("vacancy_id", "vacancy_name"))


@query("c3_left_out", """select 'items.csv' as file_source, count(*) as row_cnt, 0::bigint as left_out_cnt from lineitem
union all select 'orders.csv', count(*), 0 from orders union all select 'customers.csv', count(*), 0 from customer
union all select 'suppliers.csv', count(*), count(*) from supplier""")
def c3_left_out(spark, sf):
    folder = written(spark, sf, "dumps", _write_dumps(spark, sf))
    return left_out(canonical_dumps(spark, folder, JOB_DUMPS), ("vacancy_id", "vacancy_name"))


@query("c4_silver_profile", f"""with {VAC}, s as (select * from vac
  qualify row_number() over (partition by id order by published_at_utc desc, url) = 1)
select 'rows' as report, null as value, count(*) as cnt from s
union all select 'role', role_ids[1], count(*) from s group by 2
union all select 'schedule', schedule_id, count(*) from s group by 2
union all select 'internship', cast(internship as varchar), count(*) from s group by 2
union all select 'published', cast(cast(published_at_utc + to_minutes(off_min) as date) as varchar), count(*) from s group by 2""")
def c4(spark, sf):
    from marketlake.operators.facets import facet_counts
    from marketlake.plans.silver import with_local_times

    rows = with_local_times(scan_partitioned(spark, silver(spark, sf)))
    counts = facet_counts(rows, {
        "rows": F.lit(None), "role": first_item(F.col("professional_roles"))["id"],
        "schedule": F.col("schedule.id"), "internship": F.col("internship"),
        "published": F.col("published_date")})
    return counts.withColumnsRenamed({"facet": "report", "found": "cnt"})


_LATEST = "qualify row_number() over (partition by id order by published_at_utc desc, url) = 1"


@query("c4_list_reports", f"""with {VAC}, s as (select * from vac {_LATEST})
select 'work_format' as "column", case when work_format_ids is null then null else '[' || array_to_string(list_transform(work_format_ids,
    lambda w: '{{"id":"' || w || '","name":"' || case w when 'ON_SITE' then 'on site' else lower(w) end || '"}}'), ',') || ']' end as value,
  cast(len(work_format_ids) as bigint) as len, count(*) as cnt from s group by work_format_ids
union all select 'relations', '[]', 0, count(*) from s
union all select 'working_days', null, null, count(*) from s""")
def c4_lists(spark, sf):
    rows = scan_partitioned(spark, silver(spark, sf))
    return list_reports(rows, ["work_format", "relations", "working_days"])


def _profile(spark, sf, name):
    return profile_silver(scan_partitioned(spark, silver(spark, sf)), [name])[name]


@query("c4_role_report", f"""with {VAC}, s as (select * from vac {_LATEST})
select 'Role ' || role_ids[1][2:] as professional_role, count(*) as rows_cnt from s group by 1""")
def c4_roles(spark, sf):
    return _profile(spark, sf, "roles")


@query("c4_fill_report", f"""with {VAC}, s as (select * from vac {_LATEST})
select rows_cnt, unique_cnt, null_cnt, round(null_cnt / rows_cnt * 100, 2) as null_prcnt,
  round(null_cnt / (rows_cnt + null_cnt) * 100, 2) as null_share from (
select count(responsibility) as rows_cnt, count(distinct responsibility) as unique_cnt,
  count(*) filter (where responsibility is null) as null_cnt from s)""")
def c4_fill(spark, sf):
    return _profile(spark, sf, "responsibility")


_S = f"with {VAC}, s as (select * from vac {_LATEST})"


@query("c4_ids", f"{_S} select count(*) as rows_cnt, count(distinct id) as unique_id_cnt from s")
def c4_ids(spark, sf):
    return _profile(spark, sf, "ids")


@query("c4_schedule", f"{_S} select schedule_id, count(*) as rows_cnt, count(distinct id) as unique_id_cnt from s group by 1")
def c4_schedule(spark, sf):
    return _profile(spark, sf, "schedule").select(F.col("schedule.id").alias("schedule_id"), "rows_cnt", "unique_id_cnt")


@query("c4_list_values", f"{_S} select unnest([{', '.join(repr(c) for c in LIST_REPORTS)}]) as \"column\", "
       "null::varchar as value, null::bigint as len, (select count(*) from s) as cnt")
def c4_list_values(spark, sf):
    return _profile(spark, sf, "list_values")


@query("c4_role_values", f"""{_S}, v as (select '[' || array_to_string(list_transform(role_ids,
    lambda r: '{{"id":"' || r || '","name":"Role ' || r[2:] || '"}}'), ',') || ']' as value,
  cast(len(role_ids) as bigint) as len, count(*) as cnt from s group by role_ids)
select 'professional_roles' as "column", value, len, cnt from v order by cnt desc, value limit 10""")
def c4_role_values(spark, sf):
    """The ten most frequent values of a list column that is filled, of 21."""
    return list_reports(scan_partitioned(spark, silver(spark, sf)), ["professional_roles"])


@query("c4_role_lengths", f"""{_S}, n as (select len(role_ids) as n from s)
select min(n) as min_len, max(n) as max_len, round(avg(n), 6) as avg_len, quantile_cont(n, 0.5) as median_len from n""")
def c4_role_lengths(spark, sf):
    return _profile(spark, sf, "role_list_lengths").select("min_len", "max_len", "avg_len", "median_len")


@query("c4_role_lists", f"""{_S} select count(role_ids) as rows_cnt, count(distinct role_ids) as unique_cnt,
  count(distinct role_ids[1]) as unique_names_cnt, count(distinct role_ids[1]) as unique_ids_cnt from s""")
def c4_role_lists(spark, sf):
    return _profile(spark, sf, "role_lists")


@query("c4_requirement", f"""{_S}
select rows_cnt, unique_cnt, null_cnt, round(null_cnt / rows_cnt * 100, 2) as null_prcnt,
  round(null_cnt / (rows_cnt + null_cnt) * 100, 2) as null_share from (
select count(requirement) as rows_cnt, count(distinct requirement) as unique_cnt,
  count(*) filter (where requirement is null) as null_cnt from s)""")
def c4_requirement(spark, sf):
    return _profile(spark, sf, "requirement")


@query("c4_is_adv_vacancy", f"{_S} select null::boolean as is_adv_vacancy, count(*) as rows_cnt from s")
def c4_adv(spark, sf):
    return _profile(spark, sf, "is_adv_vacancy")


@query("c4_internship", f"{_S} select internship, count(*) as rows_cnt from s group by 1")
def c4_internship(spark, sf):
    return _profile(spark, sf, "internship")


@query("c4_accept_temporary", f"{_S} select accept_temporary, count(*) as rows_cnt from s group by 1")
def c4_temporary(spark, sf):
    return _profile(spark, sf, "accept_temporary")


@query("c5_repeats_by_date", f"""with {VAC}
select cast(ts as date) as date, count(id) as total_id_cnt, count(distinct id) as unique_id_cnt,
  round((count(id) - count(distinct id)) / count(id) * 100, 2) as share_of_duplicates_pcnt
from vac group by 1""")
def c5(spark, sf):
    return repeats_by_date(dated_records(spark, sf))


def dated_records(spark, sf):
    """(date, id, url) of the bronze records, the date taken from the path."""
    from marketlake.sources.tables import path_date

    raw = spark.read.schema("id string, url string, published_at string").json(
        bronze(spark, sf))
    return raw.select("id", "url", "published_at", path_date(F.col("_metadata.file_path")).alias("date"))


@query("c5_copies_of_top_key", f"""with {VAC}, t as (select id from vac group by 1 order by count(*) desc, id limit 1)
select id, count(*) as row_cnt, count(distinct (url, published_at)) as distinct_row_cnt
from vac join t using (id) group by 1""")
def c5_copies(spark, sf):
    return copies_of_top_key(dated_records(spark, sf).drop("date"))


@query("c6_bounded_batches", """with m as (select event_id, cast((ts at time zone 'UTC') at time zone 'Europe/Moscow' as date) as run from events)
select run, count(*) as row_cnt, cast(sum(event_id) as bigint) as id_sum, true as pages_ok from m group by 1""")
def c6(spark, sf):
    path = scratch_path(spark, "c6")
    ev = events(spark, sf).select("event_id", "ts", "event_type", "user_id")
    rows = batch_rows(ev, F.col("ts"), F.col("event_id"),
                      {"type": F.col("event_type"), "bucket": F.col("user_id") % 4},
                      cap=20, per_page=10)
    write_jsonl_batches(rows, path, rows_per_file=10_000)
    schema = "run date, first_second bigint, dim_type string, dim_bucket string, page bigint, event_id bigint"
    back = spark.read.schema(schema).json(path)
    pages = back.groupBy("run", "first_second", "dim_type", "dim_bucket", "page").agg(
        n_rows("n"), F.sum("event_id").alias("s"))
    return pages.groupBy("run").agg(
        F.sum("n").alias("row_cnt"), F.sum("s").alias("id_sum"),
        (F.max("n") <= 10).alias("pages_ok"))


@query("g1_top_terms", r"""with w as (select lang, unnest(regexp_split_to_array(lower(text), '\s+')) as term from documents),
c as (select lang, term, count(*) as cnt from w where term <> '' group by all)
select lang, term, cnt, row_number() over (partition by lang order by cnt desc, term) as rank from c
qualify row_number() over (partition by lang order by cnt desc, term) <= 10""")
def g1(spark, sf):
    words = F.split(F.lower("text"), r"\s+")
    return top_terms(table(spark, sf, "documents").select("lang", words.alias("terms")),
                     "lang", "terms", 10)


def flagship(spark, sf):
    """Newest version of every vacancy with UTC times, offsets and flat fields."""
    from marketlake.plans.silver import clean

    return flat_silver(clean(vacancies(spark, sf), TIES))


query("c1_flagship", f"""with {VAC}
select {_FLAT} from vac
qualify row_number() over (partition by id order by published_at_utc desc, url) = 1""")(flagship)


@query("c1_enriched_rows", f"""with {VAC} select {_FLAT} from vac""")
def c1_enriched(spark, sf):
    return flat_silver(enrich(scan_jsonl(spark, bronze(spark, sf))))
