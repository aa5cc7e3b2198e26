"""Raw to silver: versions, offsets, late rows and safe re-runs."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from marketlake.plans.profile import profile_silver
from marketlake.plans.silver import bronze_to_silver, clean, silver_metrics, silver_run, with_local_times
from marketlake.sources.jsonl import scan_jsonl
from marketlake.sources.tables import scan_day, scan_partitioned
from test_jsonl import write


def line(id_, at, name="n", **more):
    return json.dumps({"id": id_, "name": name, "published_at": at, "created_at": at, **more})


def test_latest_by_instant_not_by_text(spark, tmp_path):
    path = write(tmp_path, [line("9", "2025-12-04T10:00:00+0300", "old"),
                            line("9", "2025-12-04T09:30:00+0000", "new")])
    got = clean(scan_jsonl(spark, path)).select("id", "name").collect()
    assert [tuple(r) for r in got] == [("9", "new")]


def test_equal_instants_give_one_stable_row(spark, tmp_path):
    lines = [line("1", "2025-12-04T10:00:00+0300", n) for n in "abcdef"]
    a = rows(clean(scan_jsonl(spark, write(tmp_path / "a", lines))).select("id", "name"))
    b = rows(clean(scan_jsonl(spark, write(tmp_path / "b", lines[::-1]))).select("id", "name"))
    assert len(a) == 1 and a == b


def test_utc_plus_offset_is_wall_time(spark, tmp_path):
    lines = [line("1", "2025-12-04T10:09:13+0300"), line("2", "2025-12-04T10:09:13-0330"),
             line("3", "2025-12-04T10:09:13+0000"), line("4", "not a date"), line("5", None)]
    got = {r["id"]: r for r in with_local_times(
        clean(scan_jsonl(spark, write(tmp_path, lines)))).collect()}
    assert {i: got[i]["published_at_offset"] for i in "12345"} == {
        "1": 180, "2": -210, "3": 0, "4": None, "5": None}
    for i in "123":
        assert got[i]["published_at_local"] == dt.datetime(2025, 12, 4, 10, 9, 13)
    assert got["2"]["published_at_utc"] == dt.datetime(2025, 12, 4, 13, 39, 13)


def test_write_twice_equals_write_once_and_late_rows_merge(spark, tmp_path):
    day1 = write(tmp_path / "d1", [line("1", "2025-12-01T10:00:00+0000"),
                                   line("2", "2025-12-01T11:00:00+0000")])
    day10 = write(tmp_path / "d10", [line("3", "2025-12-10T10:00:00+0000"),
                                     line("4", "bad date")])
    # The second day's file carries a late row of day 1 and a newer version of id 2.
    day2 = write(tmp_path / "d2", [line("5", "2025-12-01T23:30:00+0000"),
                                   line("2", "2025-12-01T12:00:00+0000", "newer"),
                                   line("6", "2025-12-02T10:00:00+0000"),
                                   line("7", "bad date")])
    silver = str(tmp_path / "silver")
    for batch in (day1, day10, day2):
        bronze_to_silver(spark, batch, silver)
    once = rows(scan_partitioned(spark, silver).select("id", "name", "year", "month", "day"))
    for batch in (day2, day1):
        bronze_to_silver(spark, batch, silver)
    again = rows(scan_partitioned(spark, silver).select("id", "name", "year", "month", "day"))
    assert once == again == sorted([
        ("1", "n", 2025, 12, 1), ("2", "newer", 2025, 12, 1), ("5", "n", 2025, 12, 1),
        ("6", "n", 2025, 12, 2), ("3", "n", 2025, 12, 10),
        ("4", "n", 0, 0, 0), ("7", "n", 0, 0, 0)], key=repr)
    one = scan_day(spark, silver, 2025, 12, 1)
    assert one.count() == 3 and not {"year", "month", "day"} & set(one.columns)
    assert len(scan_partitioned(spark, silver).columns) == 54


def test_metrics_count_nulls(spark, tmp_path):
    path = write(tmp_path, [line("1", "2025-12-04T10:00:00+0300"),
                            line("2", "2025-12-04T11:00:00+0300", salary={"from": 1})])
    got = silver_metrics(clean(scan_jsonl(spark, path))).first()
    assert (got["row_count"], got["salary_null_rate"]) == (2, 0.5)


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(100).select(
        F.concat(F.lit("hot"), F.col("id") % 1).alias("id"), F.col("id").cast("string").alias("published_at"),
        F.lit(None).cast("string").alias("created_at"))
    plan = clean(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_profile_reports_run_on_the_whole_contract(spark, tmp_path):
    path = write(tmp_path, [
        line("1", "2025-12-04T10:00:00+0300", internship=True, working_days=[],
             professional_roles=[{"id": "1", "name": "Courier"}], snippet={"requirement": "r"}),
        line("2", "2025-12-04T11:00:00+0300", schedule={"id": "s", "name": "shift"}),
    ])
    reports = {k: v.collect() for k, v in profile_silver(clean(scan_jsonl(spark, path))).items()}
    assert tuple(reports["ids"][0]) == (2, 2)
    assert len(reports["nulls_and_empty"]) == 51
    assert {r["professional_role"]: r["rows_cnt"] for r in reports["roles"]} == {"Courier": 1, None: 1}
    assert {(r["column"], r["value"], r["cnt"]) for r in reports["list_values"]} >= {
        ("working_days", "[]", 1), ("working_days", None, 1), ("working_hours", None, 2)}
    assert tuple(reports["requirement"][0])[:3] == (1, 1, 1)
    assert len(reports) == 12


def test_merge_opens_only_the_days_of_the_batch(spark, tmp_path):
    """The files of all other days are made unreadable; the merge must not notice."""
    silver = str(tmp_path / "silver")
    month = write(tmp_path / "m", [line(str(d), f"2025-12-{d:02d}T10:00:00+0000") for d in range(1, 31)])
    bronze_to_silver(spark, month, silver)
    others = [p for p in (tmp_path / "silver").rglob("part-*") if "day=7/" not in str(p)]
    assert len(others) >= 29
    for p in others:
        p.write_bytes(b"not parquet")
        crc = p.with_name(f".{p.name}.crc")
        if crc.exists():
            crc.unlink()
    batch = write(tmp_path / "b", [line("7", "2025-12-07T12:00:00+0000", "newer"), line("70", "2025-12-07T13:00:00+0000")])
    bronze_to_silver(spark, batch, silver)
    day = spark.read.parquet(f"{silver}/year=2025/month=12/day=7").select("id", "name")
    assert rows(day) == [("7", "newer"), ("70", "n")]


def test_only_a_missing_path_means_a_new_table(spark, tmp_path):
    from pyspark.errors import AnalysisException

    import marketlake.sinks.writers as writers

    df = spark.sql("select 1 as a")
    assert writers._stored(df, str(tmp_path / "none")) is None
    df.write.parquet(str(tmp_path / "table"))
    with pytest.raises(AnalysisException, match="already exists"):
        writers._stored(spark.sql("select 1 as a, 2 as a"), str(tmp_path / "table"))


def test_whole_job_keeps_a_ledger_and_can_be_run_again(spark, tmp_path):
    batch = write(tmp_path / "b", [
        line("1", "2025-12-01T10:00:00+0000"), "{bad", line(None, "2025-12-01T10:00:00+0000"),
        line("2", "2025-12-01T10:00:00+0000", internship="x", extra=1), line("1", "2025-12-01T11:00:00+0000")])
    silver, ledger = str(tmp_path / "silver"), str(tmp_path / "ledger")
    found = []
    for _ in range(2):
        silver_run(spark, batch, silver, ledger, "2025-12-01")
        found.append([
            rows(scan_partitioned(spark, silver).select("id", "published_at_utc")),
            rows(spark.read.json(f"{ledger}/quarantine").groupBy("reason").count()),
            rows(spark.read.json(f"{ledger}/metrics").select("lines_read", "lines_rejected", "lines_kept", "row_count")),
            rows(spark.read.json(f"{ledger}/drift").filter("status = 'new'").select("column", "line_cnt")),
        ])
    assert found[0] == found[1]
    assert [r[0] for r in found[0][0]] == ["1", "2"]
    assert found[0][1:] == [[("bad_field", 1), ("broken_line", 1), ("no_key", 1)], [(5, 2, 3, 2)], [("extra", 1)]]


def test_whole_job_without_usable_lines(spark, tmp_path):
    """A list in a line, no usable line, a blank line, an empty file: silver and ledger agree."""
    silver, ledger = str(tmp_path / "silver"), str(tmp_path / "ledger")
    good = line("1", "2025-12-01T10:00:00+0000")
    for run, lines in {"a": [good, f"[{line('9', '2025-12-01T10:00:00+0000')}]", "5"], "b": ["{bad"], "c": []}.items():
        silver_run(spark, write(tmp_path / run, lines), silver, ledger, run)
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "part.jsonl").write_bytes(b"")
    silver_run(spark, str(tmp_path / "d"), silver, ledger, "d")
    metrics = spark.read.schema("lines_read bigint, lines_kept bigint, row_count bigint, "
                                "salary_null_rate double, min_date timestamp_ntz, run string").json(f"{ledger}/metrics")
    first = dt.datetime(2025, 12, 1, 10)
    assert rows(metrics) == [
        (0, 0, 0, None, None, "d"), (1, 0, 0, None, None, "b"), (1, 0, 0, None, None, "c"),
        (3, 1, 1, 1.0, first, "a")]
    assert [r["id"] for r in scan_partitioned(spark, silver).collect()] == ["1"]


def test_a_run_that_finds_nothing_more_empties_its_ledger_entry(spark, tmp_path):
    from marketlake.sinks.writers import write_ledger

    path = str(tmp_path / "ledger")
    some = spark.sql("select 'x' as reason")
    write_ledger(some, path, "a")
    write_ledger(some, path, "b")
    write_ledger(some.filter("false"), path, "a")
    assert rows(spark.read.schema("reason string, run string").json(path)) == [("x", "b")]
