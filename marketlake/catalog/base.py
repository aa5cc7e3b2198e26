"""Registry of queries and the vacancy-shaped input they derive from ``events``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import scratch_path, use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that must give the same rows where there is one."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


# --- vacancies derived from events -------------------------------------------
# One record per event: the user is the vacancy id (so ids repeat), ``ts`` is the
# local publication time, and the offset, nested fields, NULLs and empty lists follow
# from the event's own values.

_VACANCY_EXPRS = [
    "cast(user_id as string) as id",
    "event_type as name",
    "if(event_id % 4 = 3, null, named_struct('id', concat('s', event_id % 4), "
    "'name', concat('schedule ', event_id % 4))) as schedule",
    "event_id % 5 = 0 as internship",
    "if(event_id % 6 = 0, null, event_id % 2 = 0) as accept_temporary",
    "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), off) as published_at",
    "concat(date_format(ts - interval 1 day, \"yyyy-MM-dd'T'HH:mm:ss\"), off) as created_at",
    "concat('v/', event_id) as url",
    "if(event_type = 'error', null, named_struct('from', cast(floor(value * 100) as bigint), "
    "'to', if(event_id % 3 = 0, null, cast(floor(value * 150) as bigint)), "
    "'currency', 'RUR', 'gross', event_id % 2 = 0)) as salary",
    "named_struct('id', concat('e', user_id % 20), 'name', concat('Employer ', user_id % 20), "
    "'trusted', user_id % 2 = 0) as employer",
    "named_struct('id', cast(user_id % 25 as string), 'name', concat('NATION_', user_id % 25)) "
    "as area",
    "if(event_id % 10 = 9, null, named_struct('id', element_at(array('FULL', 'PART', 'PROJECT', "
    "'FLY_IN_FLY_OUT', 'SIDE_JOB'), cast(event_id % 5 + 1 as int)))) as employment_form",
    "case event_id % 4 when 0 then null "
    "when 1 then cast(array() as array<struct<id:string,name:string>>) "
    "when 2 then array(named_struct('id', 'ON_SITE', 'name', 'on site')) "
    "else array(named_struct('id', 'REMOTE', 'name', 'remote'), "
    "named_struct('id', 'HYBRID', 'name', 'hybrid')) end as work_format",
    "transform(sequence(0, cast(event_id % 3 as int)), i -> named_struct("
    "'id', concat('r', (user_id + i) % 7), 'name', concat('Role ', (user_id + i) % 7))) "
    "as professional_roles",
    "cast(array() as array<string>) as relations",
    "named_struct('requirement', if(event_id % 7 = 0, null, concat(event_type, ' ', user_id % 11)), "
    "'responsibility', if(event_id % 11 = 0, null, concat('duty ', user_id % 13))) as snippet",
    "if(event_id % 3 = 0, 1, null) as extra",
    "if(day(ts) >= 15, named_struct('logo', 'l'), null) as brand_snippet",
]

# The same columns, flattened where a query needs them, for the SQL side.
VAC = """vac as (
 select e.*, cast(user_id as varchar) as id, event_type as name,
  case when event_id % 4 = 3 then null else 's' || (event_id % 4) end as schedule_id,
  event_id % 5 = 0 as internship,
  case when event_id % 6 = 0 then null else event_id % 2 = 0 end as accept_temporary,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') || off as published_at,
  strftime(ts - interval 1 day, '%Y-%m-%dT%H:%M:%S') || off as created_at,
  date_trunc('second', ts) - to_minutes(off_min) as published_at_utc,
  date_trunc('second', ts) - interval 1 day - to_minutes(off_min) as created_at_utc,
  'v/' || event_id as url,
  case when event_type = 'error' then null else cast(floor(value * 100) as bigint) end as salary_from,
  case when event_type = 'error' or event_id % 3 = 0 then null
       else cast(floor(value * 150) as bigint) end as salary_to,
  'e' || (user_id % 20) as employer_id,
  cast(user_id % 25 as varchar) as area_id, 'NATION_' || (user_id % 25) as area_name,
  case when event_id % 10 = 9 then null else
    ['FULL', 'PART', 'PROJECT', 'FLY_IN_FLY_OUT', 'SIDE_JOB'][cast(event_id % 5 + 1 as int)] end
    as employment_form_id,
  case event_id % 4 when 0 then null when 1 then cast([] as varchar[])
    when 2 then ['ON_SITE'] else ['REMOTE', 'HYBRID'] end as work_format_ids,
  list_transform(range(0, cast(event_id % 3 as int) + 1), lambda i: 'r' || ((user_id + i) % 7)) as role_ids,
  case when event_id % 7 = 0 then null else event_type || ' ' || (user_id % 11) end as requirement,
  case when event_id % 11 = 0 then null else 'duty ' || (user_id % 13) end as responsibility
 from (select *, case event_id % 3 when 0 then '+0300' when 1 then '+0000' else '-0330' end as off,
       case event_id % 3 when 0 then 180 when 1 then 0 else -210 end as off_min from events) e
)"""


def _vacancies_of(ev: DataFrame) -> DataFrame:
    off = "case event_id % 3 when 0 then '+0300' when 1 then '+0000' else '-0330' end as off"
    return ev.selectExpr("*", off).selectExpr("event_id", "ts", *_VACANCY_EXPRS)


def vacancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vacancy records plus ``event_id`` and ``ts`` of the event they came from."""
    return _vacancies_of(events(spark, sf_dir))


#: Lines of one task that writes them, on average.  It sorts them by the folder they go to, in memory.
LINES_PER_TASK = 100_000


def _by_day(ev: DataFrame) -> DataFrame:
    """The events in ranges of days of a bounded number of rows; a day may take several.

    A line is many times as long as its event, so events are spread before they become lines.
    """
    tasks = max(1, -(-ev.count() // LINES_PER_TASK))
    # A seeded draw per row parts the rows of a day, whatever their ids.
    return ev.repartitionByRange(tasks, F.to_date("ts"), F.rand(0))


def vacancy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, date, value): JSON lines with the date of the file they belong to."""
    vac = _vacancies_of(_by_day(events(spark, sf_dir)))
    record = F.struct(*[c for c in vac.columns if c not in ("event_id", "ts")])
    return vac.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.to_json(record).alias("value"),
    )


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines, with some broken, some without id and some with a bad field."""
    line = F.col("value")
    kind = F.col("event_id") % 10
    damaged = (
        F.when(kind == 0, F.expr("left(value, length(value) - 5)"))
        .when(kind == 1, F.regexp_replace(line, '"id":"[0-9]+","name"', '"id":null,"name"'))
        .when(kind == 2, F.regexp_replace(line, '"internship":(true|false)', '"internship":"x"'))
        .when(kind == 3, F.regexp_replace(line, '"schedule":\\{[^}]*\\}', '"schedule":"oops"'))
        .otherwise(line)
    )
    return vacancy_lines(spark, sf_dir).withColumn("value", damaged)


_WRITTEN: dict[tuple, str] = {}


def written(spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]) -> str:
    """Write a derived input once per session and scale, and return its folder."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _WRITTEN:
        path = scratch_path(spark, label)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def _write_lines(lines: Callable[[SparkSession, str], DataFrame], spark: SparkSession,
                 sf_dir: str) -> Callable[[str], None]:
    def write(path: str) -> None:
        (
            lines(spark, sf_dir).select("date", "value").write.partitionBy("date")
            .option("compression", "gzip").option("maxRecordsPerFile", 10_000).text(path)
        )

    return write


def bronze(spark: SparkSession, sf_dir: str) -> str:
    """Folder of gz JSON lines under ``date=YYYY-MM-DD/``."""
    return written(spark, sf_dir, "bronze", _write_lines(vacancy_lines, spark, sf_dir))


def damaged_bronze(spark: SparkSession, sf_dir: str) -> str:
    return written(spark, sf_dir, "damaged", _write_lines(damaged_lines, spark, sf_dir))
