"""Derived lines are written by tasks of a bounded number of rows."""

import datetime as dt
import re

from marketlake.catalog import base


def _events(spark, path, days):
    rows = [(k, day and day + dt.timedelta(seconds=k), k % 7, "view", float(k)) for k, day in enumerate(days)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/events.parquet")


def _written(spark, sf, monkeypatch, per_task):
    monkeypatch.setattr(base, "LINES_PER_TASK", per_task)
    monkeypatch.setattr(base, "_WRITTEN", {})
    lines = spark.read.text(base.bronze(spark, sf)).selectExpr("value", "_metadata.file_name as file")
    return [(re.search(r"part-(\d+)", r["file"])[1], r["value"]) for r in lines.collect()]


def test_lines_of_one_file_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """One split of 3 000 events, most of one day and some without a time."""
    monkeypatch.setattr(base, "LINES_PER_TASK", 300, raising=False)
    day = dt.datetime(2024, 1, 2, 8)
    days = [None] * 400 + [day] * 2400 + [day + dt.timedelta(days=k % 5) for k in range(200)]
    sf = str(tmp_path)
    _events(spark, sf, days)
    lines = _written(spark, sf, monkeypatch, 300)
    sizes = {t: sum(1 for x, _ in lines if x == t) for t, _ in lines}
    assert len(sizes) >= 8 and max(sizes.values()) <= 700
    assert sorted(v for _, v in lines) == sorted(v for _, v in _written(spark, sf, monkeypatch, 10_000))
    assert len(set(v for _, v in lines)) == 3000
