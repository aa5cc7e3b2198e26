"""The standard set of reports over a silver table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.lists import first_item
from marketlake.operators.profile import (
    fill_report,
    list_length_stats,
    list_reports,
    null_and_empty_report,
)

# Columns the standard profile looks at one by one.
LIST_REPORTS = [
    "working_time_modes",
    "working_time_intervals",
    "working_days",
    "working_hours",
    "work_schedule_by_days",
    "fly_in_fly_out_duration",
]


def profile_silver(silver: DataFrame, names: list[str] | None = None) -> dict[str, DataFrame]:
    """Report name -> lazy report, all of them or the named ones; each is one aggregate."""
    n_rows = F.count(F.lit(1)).alias("rows_cnt")
    roles = F.col("professional_roles")
    id_cnt = F.count_distinct("id").alias("unique_id_cnt")
    reports = {
        "ids": lambda: silver.agg(n_rows, id_cnt),
        "nulls_and_empty": lambda: null_and_empty_report(silver),
        "schedule": lambda: silver.groupBy("schedule").agg(n_rows, id_cnt),
        "list_values": lambda: list_reports(silver, LIST_REPORTS),
        "role_list_lengths": lambda: list_length_stats(silver, "professional_roles"),
        "roles": lambda: silver.groupBy(
            first_item(roles)["name"].alias("professional_role")).agg(n_rows),
        "role_lists": lambda: silver.agg(
            F.count(roles).alias("rows_cnt"),
            F.count_distinct(roles).alias("unique_cnt"),
            F.count_distinct(first_item(roles)["name"]).alias("unique_names_cnt"),
            F.count_distinct(first_item(roles)["id"]).alias("unique_ids_cnt"),
        ),
        "requirement": lambda: fill_report(silver, "snippet.requirement"),
        "responsibility": lambda: fill_report(silver, "snippet.responsibility"),
        "is_adv_vacancy": lambda: silver.groupBy("is_adv_vacancy").agg(n_rows),
        "internship": lambda: silver.groupBy("internship").agg(n_rows),
        "accept_temporary": lambda: silver.groupBy("accept_temporary").agg(n_rows),
    }
    return {name: reports[name]() for name in names or reports}
