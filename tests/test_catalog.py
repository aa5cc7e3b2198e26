"""Registered queries against their SQL, and rules every query follows."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no generated tables")

# One or two per section; tools/compare.py runs all of them.
CHECKED = [
    "s3_tolerant_scan", "s6_dump_scan", "k4_rerun_day", "k7_quarantine_ledger",
    "a3_duplicate_share", "a15_facet_counts", "a18_daily_series", "w1_latest_per_key",
    "j1_report_join", "o3_list_column_report", "f7_iso_moscow", "t1_bisect_slices",
    "t2_overlapping_slices", "t3_adaptive_walk", "t4_drill_deep", "q1_schema_drift",
    "c1_damaged_input", "c3_consolidate_dumps",
]


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, name):
    line = compare(spark, duck(SF), name, SF)
    assert line.startswith("OK"), line


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 130
