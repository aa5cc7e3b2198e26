"""Six differently laid out dumps to one canonical table."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.times import iso_with_offset, parse_dump_time
from marketlake.operators.dedup import keep_latest
from marketlake.sources.dumps import scan_dump

CANONICAL = ("vacancy_id", "vacancy_name", "date_published", "salary_from", "data_source",
             "file_source")
DEFAULT_SOURCE = "hh"


@dataclass(frozen=True)
class Dump:
    """Layout of one dump: separator, time layout and canonical name -> source column.

    Files with quoted line breaks are found by a pass over the lines and read in one task
    each; ``multiline`` True or False says it beforehand.
    """

    name: str
    sep: str
    time_layout: str
    columns: dict[str, str] = field(default_factory=dict)
    multiline: bool | None = None


# --- Fixed values: layouts of the published dumps ----------------------------
DUMPS = [
    Dump("data_analyst_vacancies_hh_by_lludop.csv", ";", "dd.MM.yyyy HH:mm",
         {"vacancy_id": "id_vac", "vacancy_name": "name", "date_published": "published_at",
          "salary_from": "salary"}),
    Dump("it_vacancies_hh_by_ilyazawilsiv.csv", ",", "yyyy-MM-dd HH:mm:ss[XXX][XX]",
         {"vacancy_id": "id", "vacancy_name": "name", "date_published": "created_at",
          "salary_from": "salary_from"}),
    Dump("it_vacancy_data_hh_by_figshare.csv", ",", "yyyy-MM-dd",
         {"vacancy_id": "id", "vacancy_name": "name", "date_published": "published_at"}),
    Dump("jobs_raw_data_hh_by_etietopabraham.csv", ";", "dd.MM.yyyy",
         {"vacancy_id": "id", "vacancy_name": "title", "date_published": "date_of_post",
          "salary_from": "salary"}),
    Dump("resume_job_matching_dataset_hh_by_darysha.csv", "|", "yyyy-MM-dd HH:mm:ss[XXX][XX]",
         {"vacancy_name": "positionName", "date_published": "publishedDate"}),
    Dump("vacancies_data_hh_trudvsem_superjob_rabotaru_by_mendeley_data.csv", ";",
         "yyyy-MM-dd HH:mm:ss",
         {"vacancy_id": "id", "date_published": "last_found_at", "salary_from": "salary_from",
          "data_source": "data_source"}),
]
# -----------------------------------------------------------------------------


def to_canonical(raw: DataFrame, dump: Dump) -> DataFrame:
    """Rename, cast and stamp one dump; columns it lacks are left out.

    The publication time is kept as UTC in ``published_utc``.  A dump without ids gets
    one from a hash of its mapped columns, marked by ``~``, so its rows stay countable.
    """
    out = []
    texts = {name: F.col(f"`{source}`").cast("string") for name, source in dump.columns.items()}
    if "vacancy_id" not in texts:
        filled = [F.coalesce(t, F.lit("")) for t in texts.values()]
        out.append(F.concat(F.lit("~"), F.md5(F.concat_ws("\x1f", *filled))).alias("vacancy_id"))
    for name, value in texts.items():
        if name == "date_published":
            name, value = "published_utc", parse_dump_time(value, dump.time_layout)
        out.append(value.alias(name))
    if "data_source" not in dump.columns:
        out.append(F.lit(DEFAULT_SOURCE).alias("data_source"))
    return raw.select(*out, F.lit(dump.name).alias("file_source"))


def _union(frames: list[DataFrame]) -> DataFrame:
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    for name in CANONICAL:
        if name not in merged.columns and name != "date_published":
            merged = merged.withColumn(name, F.lit(None).cast("string"))
    if "published_utc" not in merged.columns:
        merged = merged.withColumn("published_utc", F.lit(None).cast("timestamp_ntz"))
    return merged


def merge_dumps(frames: list[DataFrame], required: tuple[str, ...] = ("vacancy_id",)) -> DataFrame:
    """Union by name, drop rows lacking a required value, one row per (id, source).

    Requiring only the id keeps dumps without names; ``required=("vacancy_id",
    "vacancy_name")`` drops them; ``left_out`` counts what is dropped.  Of equal keys the
    newest publication stays, then the smallest row in column order, so the result does
    not depend on file order.  Times become text only for the rows that stay.
    """
    merged = _union(frames).dropna("any", subset=list(required))
    order = [F.col("published_utc").desc_nulls_last()] + [
        F.col(c).asc_nulls_first() for c in ("vacancy_name", "salary_from", "file_source")
    ]
    kept = keep_latest(merged, ["vacancy_id", "data_source"], order)
    return kept.withColumn("date_published", iso_with_offset(F.col("published_utc"))).select(*CANONICAL)


def left_out(frames: list[DataFrame], required: tuple[str, ...] = ("vacancy_id",)) -> DataFrame:
    """(file_source, row_cnt, left_out_cnt): rows of every dump, and those ``merge_dumps`` drops."""
    lacks = F.greatest(*[F.col(c).isNull() for c in required], F.lit(False))
    return _union(frames).groupBy("file_source").agg(
        F.count(F.lit(1)).alias("row_cnt"), F.count_if(lacks).alias("left_out_cnt"))


def canonical_dumps(spark: SparkSession, folder: str, dumps: list[Dump] = DUMPS) -> list[DataFrame]:
    """Every dump of ``folder`` in canonical form."""
    return [to_canonical(scan_dump(spark, f"{folder}/{d.name}", d.sep, d.multiline), d) for d in dumps]


def consolidate(spark: SparkSession, folder: str, dumps: list[Dump] = DUMPS,
                required: tuple[str, ...] = ("vacancy_id",)) -> DataFrame:
    """Read every dump of ``folder`` and merge them."""
    return merge_dumps(canonical_dumps(spark, folder, dumps), required)
