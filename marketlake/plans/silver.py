"""Raw records to the typed, de-duplicated silver table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.times import local_time, offset_minutes_of_text, utc_of_text
from marketlake.operators.dedup import keep_any, keep_latest, row_hash
from marketlake.operators.quality import drift_of_keys, metric_columns
from marketlake.session import discard, observed_table
from marketlake.sinks.writers import merge_days, with_day_keys, write_ledger
from marketlake.sources.contract import VACANCY
from marketlake.sources.jsonl import parsed_lines, scan_jsonl, scan_lines

TIME_COLUMNS = ("published_at", "created_at")


def with_utc_and_offset(df: DataFrame) -> DataFrame:
    """Replace the two source time strings by UTC times and offset minutes."""
    added: dict[str, Column] = {}
    for name in TIME_COLUMNS:
        added[f"{name}_utc"] = utc_of_text(F.col(name))
    for name in TIME_COLUMNS:
        added[f"{name}_offset"] = offset_minutes_of_text(F.col(name))
    return df.withColumns(added).drop(*TIME_COLUMNS)


def with_local_times(df: DataFrame) -> DataFrame:
    """Add local times from UTC and offset, and the local publication date."""
    return df.withColumns({
        "published_at_local": local_time(F.col("published_at_utc"), F.col("published_at_offset")),
        "created_at_local": local_time(F.col("created_at_utc"), F.col("created_at_offset")),
    }).withColumn("published_date", F.to_date("published_at_local"))


def latest_first(tie_break: list[str] | None = None) -> list[Column]:
    """Order of versions of one vacancy: newest instant first, NULL times last."""
    return [F.col("published_at_utc").desc_nulls_last(), *[F.col(c).asc() for c in tie_break or []]]


def enrich(records: DataFrame) -> DataFrame:
    """Rows with a key, their times as UTC and offset."""
    return with_utc_and_offset(records.filter(F.col("id").isNotNull()))


def clean(records: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """Typed silver rows of a batch: key present, newest version of each id.

    Versions are compared by instant, not by their text, and equal instants by
    ``tie_break`` and then by a hash of the row, so a re-run picks the same row.
    """
    enriched = enrich(records)
    order = [*latest_first(tie_break), row_hash(enriched).desc()]
    return keep_latest(enriched, ["id"], order)


def clean_any(records: DataFrame) -> DataFrame:
    """Variant that keeps an arbitrary version of each id."""
    return with_utc_and_offset(keep_any(records, ["id"]))


def bronze_to_silver(spark: SparkSession, bronze_path: str, silver_path: str,
                     tie_break: list[str] | None = None) -> None:
    """Clean one batch of raw files and merge it into the silver days it touches."""
    rows = with_day_keys(clean(scan_jsonl(spark, bronze_path), tie_break), "published_at_utc")
    merge_days(rows, silver_path, "id", latest_first(tie_break))


def silver_run(spark: SparkSession, bronze_path: str, silver_path: str, ledger_path: str,
               run: str, tie_break: list[str] | None = None) -> None:
    """The whole daily job: quarantine, drift report, silver and metrics of one run.

    The ledger has a folder each for ``quarantine`` (every line that silver lacks or has
    with a field less, and why), ``drift`` (columns that are new or missing) and
    ``metrics`` (one row; the lines read are those rejected and those kept).  A re-run of
    ``run`` replaces its own entries and changes nothing else.

    The raw lines are read and parsed once, into a written table that everything else is
    taken from; counts and metrics are observed while tables are written.  A line that holds
    a list is a broken one.  A batch without usable lines leaves silver as it is, with
    metrics of no rows.
    """
    lines = as_log(parsed_lines(scan_lines(spark, bronze_path)))
    parsed, parsed_path, counts = observed_table(lines, "parsed", line_counts())
    batch = with_day_keys(clean(parsed.select("record.*"), tie_break), "published_at_utc")
    publish_parsed(parsed, counts, batch, silver_path, ledger_path, run, tie_break)
    discard(spark, parsed_path)


def as_log(parsed: DataFrame) -> DataFrame:
    """``parsed_lines`` with the text and file of rejected lines only, to be written."""
    rejected = F.col("reason").isNotNull()
    return parsed.withColumns({c: F.when(rejected, F.col(c)) for c in ("value", "file_path")})


def line_counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("lines_read"),
        F.count_if(F.col("reason").isin("broken_line", "no_key")).alias("lines_rejected"),
        F.count_if(F.col("reason") == "bad_field").alias("lines_with_bad_field"),
    ]


def publish_parsed(parsed: DataFrame, counts: dict, batch: DataFrame, silver_path: str, ledger_path: str,
                   run: str, tie_break: list[str] | None = None) -> None:
    """Merge the silver rows ``batch`` of a written table of parsed lines; write its ledger entries."""
    spark = parsed.sparkSession
    write_ledger(parsed.filter("reason is not null").select("value", "file_path", "reason"),
                 f"{ledger_path}/quarantine", run)
    keys = parsed.select(F.explode(F.array_distinct("keys")).alias("column"))
    write_ledger(drift_of_keys(keys, VACANCY).filter("status <> 'known'"), f"{ledger_path}/drift", run)
    rows, rows_path, metrics = observed_table(batch, "batch", silver_metric_columns())
    merge_days(rows, silver_path, "id", latest_first(tie_break), is_table=True)
    values = {**counts, "lines_kept": counts["lines_read"] - counts["lines_rejected"], **metrics}
    types = {f.name: f.dataType for f in silver_metrics(rows).schema}
    write_ledger(spark.range(1).select(*[
        F.lit(v).cast(types.get(c, "bigint")).alias(c) for c, v in values.items()
    ]), f"{ledger_path}/metrics", run)
    discard(spark, rows_path)


def silver_metric_columns() -> list[Column]:
    return metric_columns("salary", "published_at_utc")


def silver_metrics(silver: DataFrame) -> DataFrame:
    return silver.agg(*silver_metric_columns())
