"""Schema drift and data quality."""

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from marketlake.catalog.base import VAC, bronze, events, query, vacancies, written
from marketlake.operators.quality import (
    batch_metrics,
    column_counts,
    column_presence,
    drift_report,
    missing_columns,
    null_rate_history,
)
from marketlake.plans.reconcile import bronze_silver_difference, outlier_columns
from marketlake.plans.silver import (
    TIME_COLUMNS,
    clean,
    silver_metrics,
    with_local_times,
    with_utc_and_offset,
)
from marketlake.sinks.writers import DAY_KEYS, overwrite_days, with_day_keys
from marketlake.sources.contract import VACANCY
from marketlake.sources.footers import column_changes, columns_per_parquet_file, parquet_footers
from marketlake.sources.jsonl import scan_jsonl, scan_lines
from marketlake.sources.tables import path_date, path_parts_date

# Keys of the derived records and when a record has them (NULL fields are left out).
_ALWAYS = ["id", "name", "internship", "published_at", "created_at", "url", "employer", "area",
           "professional_roles", "relations", "snippet"]
_SOMETIMES = {"schedule": "schedule_id is not null", "accept_temporary": "accept_temporary is not null",
              "salary": "salary_from is not null", "employment_form": "employment_form_id is not null",
              "work_format": "work_format_ids is not null", "extra": "event_id % 3 = 0",
              "brand_snippet": "day(ts) >= 15"}
_KEYS = " union all ".join(
    [f"select url, published_at[1:10] as file_date, '{c}' as \"column\" from vac" for c in _ALWAYS]
    + [f"select url, published_at[1:10], '{c}' from vac where {w}" for c, w in _SOMETIMES.items()])
_KNOWN = set(_ALWAYS) | set(_SOMETIMES)
_MISSING = [c for c in VACANCY.fieldNames() if c not in _KNOWN]


def _lines(spark, sf):
    return scan_lines(spark, bronze(spark, sf))


@query("q1_schema_drift", f"""with {VAC}, k as ({_KEYS})
select "column", case when "column" = 'extra' then 'new' else 'known' end as status, count(*) as line_cnt
from k group by all
union all select unnest([{", ".join(f"'{c}'" for c in _MISSING)}]), 'missing', 0""")
def q1(spark, sf):
    return drift_report(_lines(spark, sf), VACANCY)


@query("q2_missing_columns", f"""with {VAC}, k as ({_KEYS}),
d as (select distinct file_date, "column" from k)
select f.file_date as file_path, c."column" from (select distinct file_date from d) f, (select distinct "column" from d) c
where (f.file_date, c."column") not in (select (file_date, "column") from d)""")
def q2(spark, sf):
    return missing_columns(_by_date(_lines(spark, sf)))


def _by_date(lines):
    """Take all part files of a date as one, whatever number the writer made."""
    return lines.withColumn(
        "file_path", F.date_format(path_date(F.col("file_path")), "yyyy-MM-dd")
    )


@query("q3_columns_per_file", f"""with {VAC}, k as ({_KEYS})
select file_date as file_path, count(distinct "column") as column_cnt from k group by 1""")
def q3(spark, sf):
    return column_counts(_by_date(_lines(spark, sf)))


# Silver whose files change on the 15th of a month: ``event_type`` goes, ``kind`` and ``extra``
# come, and ``value`` becomes a text.
def _changing_silver(spark, sf):
    def write(path):
        rows = with_day_keys(events(spark, sf), "ts")
        late = F.dayofmonth("ts") >= 15
        overwrite_days(rows.filter(~late).select("event_id", "event_type", "value", *DAY_KEYS), path)
        overwrite_days(rows.filter(late).select(
            "event_id", F.col("event_type").alias("kind"), F.lit(1).alias("extra"),
            F.col("value").cast("string").alias("value"), *DAY_KEYS), path)

    return parquet_footers(spark, written(spark, sf, "changing_silver", write))


def _joined(names):
    return F.array_join(names, ",")


@query("q3_silver_columns", """with d as (select ts::date as day, count(*) as row_cnt, day(any_value(ts)) >= 15 as late
  from events group by 1),
p as (select *, late and not coalesce(lag(late) over (order by day), late) as on_15th,
  not late and coalesce(lag(late) over (order by day), late) as on_1st from d)
select day, cast(row_cnt as bigint) as row_cnt, cast(case when late then 4 else 3 end as bigint) as column_cnt,
  case when on_15th then 'extra,kind' when on_1st then 'event_type' else '' end as added,
  case when on_15th then 'event_type' when on_1st then 'extra,kind' else '' end as dropped,
  case when on_15th or on_1st then 'value' else '' end as retyped from p""")
def q3_silver(spark, sf):
    """Columns of the silver files a day, from their footers."""
    changes = column_changes(_changing_silver(spark, sf), path_parts_date(F.col("file_path")), "day")
    return changes.select("day", "row_cnt", "column_cnt", *[_joined(c).alias(c) for c in ("added", "dropped", "retyped")])


@query("q3_silver_files", """select ts::date as day, cast(case when day(any_value(ts)) >= 15 then 4 else 3 end as bigint)
  as column_cnt, count(*) as row_cnt, 'ZSTD' as codecs from events group by 1""")
def q3_files(spark, sf):
    """Column counts of the single silver files; all files of a day have the same."""
    footers = _changing_silver(spark, sf)
    files = columns_per_parquet_file(footers).join(
        footers.select("file_path", _joined("codecs").alias("codecs")), "file_path")
    return files.groupBy(path_parts_date(F.col("file_path")).alias("day"), "column_cnt", "codecs").agg(
        F.sum("row_cnt").alias("row_cnt"))


@query("q4_layer_difference", f"""select unnest(['extra', 'published_at', 'created_at']) as "column", 'left' as only_in
union all select unnest([{", ".join(f"'{c}'" for c in [*_MISSING, "published_at_utc", "created_at_utc", "published_at_offset", "created_at_offset"])}]), 'right'""")
def q4(spark, sf):
    silver = with_utc_and_offset(scan_jsonl(spark, bronze(spark, sf)))
    return bronze_silver_difference(_lines(spark, sf), silver)


@query("q4_column_presence", f"""with {VAC}
select cast(ts as date) as date, count(*) as line_cnt, count(salary_from) as with_column_cnt,
  count(salary_from) > 0 as present from vac group by 1""")
def q4_presence(spark, sf):
    return column_presence(_lines(spark, sf), "salary", path_date(F.col("file_path")), "date")


@query("q5_batch_metrics", f"""with {VAC}
select count(*) as row_count, round(count_if(salary_from is null) / count(*), 6) as salary_null_rate,
  min(published_at_utc) as min_date, max(published_at_utc) as max_date from vac""")
def q5(spark, sf):
    return batch_metrics(with_utc_and_offset(vacancies(spark, sf)), "salary", "published_at_utc"
                         ).withColumn("salary_null_rate", F.round("salary_null_rate", 6))


@query("q7_offset_fill", f"""with {VAC}
select url, published_at_utc, cast(off_min as smallint) as published_at_offset,
  published_at_utc + to_minutes(off_min) as published_at_local,
  cast(published_at_utc + to_minutes(off_min) as date) as published_date from vac""")
def q7(spark, sf):
    return with_local_times(with_utc_and_offset(vacancies(spark, sf))).select(
        "url", "published_at_utc", "published_at_offset", "published_at_local", "published_date")


@query("q8_null_rate_history", f"""with {VAC}, d as (
  select cast(ts as date) as day, count_if(salary_from is null) / count(*) as salary,
    count_if(schedule_id is null) / count(*) as schedule from vac group by 1),
l as (select day, 'salary' as "column", salary as null_rate from d
  union all select day, 'schedule', schedule from d),
w as (select *, lag(null_rate) over (partition by "column" order by day) as previous_rate from l)
select day, "column", round(null_rate, 6) as null_rate, round(previous_rate, 6) as previous_rate,
  coalesce(abs(null_rate - previous_rate) > 0.04, false) as drifted from w""")
def q8(spark, sf):
    out = null_rate_history(vacancies(spark, sf), ["salary", "schedule"], F.to_date("ts"), 0.04)
    return out.withColumns({c: F.round(c, 6) for c in ("null_rate", "previous_rate")})


@query("c5_outlier_columns", f"""with {VAC}, k as ({_KEYS}),
d as (select distinct file_date, "column" from k)
select cast(f.file_date as date) as date, c."column", cast(1 as bigint) as file_cnt
from (select distinct file_date from d) f, (select distinct "column" from d) c
where (f.file_date, c."column") not in (select (file_date, "column") from d)""")
def c5_outliers(spark, sf):
    lines = _lines(spark, sf)
    folder = F.regexp_extract("file_path", "(.*date=[0-9-]+)/", 1)
    return outlier_columns(lines.withColumn("file_path", folder))


# Every column of silver: when it is NULL, and for lists when it is empty.
_SILVER = [c for c in VACANCY.fieldNames() if c not in TIME_COLUMNS] + [
    f"{c}_{part}" for c in TIME_COLUMNS for part in ("utc", "offset")]
_NULL_IF = {**{c: "false" for c in _SILVER if c in _ALWAYS or c.startswith(TIME_COLUMNS)},
            **{c: f"not ({w})" for c, w in _SOMETIMES.items() if c in _SILVER}}
_EMPTY_IF = {"work_format": "len(work_format_ids) = 0", "professional_roles": "len(role_ids) = 0", "relations": "true"}
_LISTS = [f.name for f in VACANCY if isinstance(f.dataType, ArrayType)]


def _silver_row(c):
    nulls = f"count_if({_NULL_IF.get(c, 'true')})"
    empty = f"count_if({_EMPTY_IF.get(c, 'false')})::bigint" if c in _LISTS else "null::bigint"
    share = f"round({empty} / count(*) * 100, 1)" if c in _LISTS else "null::double"
    return (f"select '{c}' as \"column\", count(*) as total_cnt, {nulls}::bigint as null_cnt, "
            f"round({nulls} / count(*) * 100, 1) as null_pcnt, {empty} as empty_list_cnt, {share} as empty_pcnt from s")


@query("q6_silver_null_empty", f"""with {VAC}, s as (select * from vac
  qualify row_number() over (partition by id order by published_at_utc desc, url) = 1)
{" union all ".join(_silver_row(c) for c in _SILVER)}""")
def q6(spark, sf):
    from marketlake.operators.profile import null_and_empty_report

    return null_and_empty_report(clean(scan_jsonl(spark, bronze(spark, sf)), ["url"]))


@query("q5_silver_metrics", f"""with {VAC}, s as (select * from vac
  qualify row_number() over (partition by id order by published_at_utc desc, url) = 1)
select count(*) as row_count, round(count_if(salary_from is null) / count(*), 6) as salary_null_rate,
  min(published_at_utc) as min_date, max(published_at_utc) as max_date from s""")
def q5_silver(spark, sf):
    silver = clean(scan_jsonl(spark, bronze(spark, sf)), ["url"])
    return silver_metrics(silver).withColumn("salary_null_rate", F.round("salary_null_rate", 6))
