"""Streaming forms give the batch result however files are split."""

import datetime as dt
import json
import os
import time

import pytest
from conftest import rows
from marketlake.catalog import QUERIES
from marketlake.streaming import ingest
from marketlake.plans.silver import bronze_to_silver, publish_parsed
from marketlake.sources.jsonl import scan_jsonl_stream, scan_lines_stream
from marketlake.sources.tables import scan_partitioned
from marketlake.streaming.ingest import (
    append_to_parquet,
    first_seen,
    publish_closed_windows,
    publish_first_seen,
    publish_window_counts,
    read_accounts,
    read_closed_windows,
    read_window_counts,
    rows_dropped_late,
    stream_run,
    stream_to_silver,
    window_counts,
)
from test_jsonl import write
from test_silver import line


def bronze(tmp_path):
    write(tmp_path / "in", [line("1", "2025-12-01T10:00:00+0000", "old"),
                            line("2", "2025-12-01T11:00:00+0000")], "date=2025-12-01/p1.jsonl.gz")
    time.sleep(1.1)  # file order of a stream follows modification time
    return write(tmp_path / "in", [line("1", "2025-12-01T12:00:00+0000", "new"),
                                   line("3", "2025-12-02T10:00:00+0000"), "{bad"],
                 "date=2025-12-02/p2.jsonl.gz")


def test_stream_equals_batch_and_continues(spark, tmp_path):
    path, out, state = bronze(tmp_path), str(tmp_path / "out"), str(tmp_path / "state")
    ledger = str(tmp_path / "ledger")
    stream_to_silver(scan_jsonl_stream(spark, path, max_files=1), out, state, ledger_path=ledger).awaitTermination()
    assert rows(spark.read.json(ledger).select("lines_read", "lines_without_id")) == [(2, 0), (3, 1)]
    bronze_to_silver(spark, path, str(tmp_path / "batch"))
    cols = ["id", "name", "year", "month", "day"]
    assert rows(scan_partitioned(spark, out).select(*cols)) == rows(
        scan_partitioned(spark, str(tmp_path / "batch")).select(*cols))
    # A later run only takes the new file.
    write(tmp_path / "in", [line("4", "2025-12-01T09:00:00+0000")], "date=2025-12-03/p3.jsonl.gz")
    again = stream_to_silver(scan_jsonl_stream(spark, path, max_files=1), out, state)
    again.awaitTermination()
    assert sum(p["numInputRows"] for p in again.recentProgress) == 1
    got = {(r["id"], r["name"], r["day"]) for r in scan_partitioned(spark, out).collect()}
    assert got == {("1", "new", 1), ("2", "n", 1), ("4", "n", 1), ("3", "n", 2)}


def test_logged_batches_are_merged_once_and_resume(spark, tmp_path, monkeypatch):
    path = bronze(tmp_path)
    places = [str(tmp_path / p) for p in ("out", "ledger", "log", "state")]

    def run():
        stream_run(scan_lines_stream(spark, path, max_files=1), *places)

    def ledger(kind, *cols):
        return rows(spark.read.json(f"{places[1]}/{kind}").select(*cols))

    merges = []
    monkeypatch.setattr("marketlake.streaming.ingest.publish_parsed",
                        lambda *args: (merges.append(args[5]), publish_parsed(*args)))
    run()
    assert merges == ["batch-0"] and not os.path.exists(places[2])
    assert {(r["id"], r["name"], r["day"]) for r in scan_partitioned(spark, places[0]).collect()} == {
        ("1", "new", 1), ("2", "n", 1), ("3", "n", 2)}
    assert ledger("quarantine", "value", "reason") == [("{bad", "broken_line")]
    assert ledger("metrics", "lines_read", "lines_kept", "row_count") == [(5, 4, 3)]
    run()  # no new file, nothing to merge
    assert merges == ["batch-0"]

    # A run that dies before its note is taken again under the same name, with what came since.
    write(tmp_path / "in", [line("4", "2025-12-01T09:00:00+0000"), "[1]"], "date=2025-12-03/p3.jsonl.gz")

    def die(*args):
        publish_parsed(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr("marketlake.streaming.ingest.publish_parsed", die)
    with pytest.raises(RuntimeError):
        run()
    monkeypatch.setattr("marketlake.streaming.ingest.publish_parsed", publish_parsed)
    write(tmp_path / "in", [line("5", "2025-12-03T09:00:00+0000"), line(None, "2025-12-03T09:00:00+0000")],
          "date=2025-12-04/p4.jsonl.gz")
    run()
    assert sorted(r["id"] for r in scan_partitioned(spark, places[0]).collect()) == ["1", "2", "3", "4", "5"]
    assert ledger("quarantine", "run", "reason") == [
        ("batch-0", "broken_line"), ("batch-2", "broken_line"), ("batch-2", "no_key")]
    assert ledger("metrics", "run", "lines_read") == [("batch-0", 5), ("batch-2", 4)]
    assert ledger("merged", "last_batch") == [(1,), (3,)]


def test_first_seen_drops_repeats_across_files(spark, tmp_path):
    records = scan_jsonl_stream(spark, bronze(tmp_path), max_files=1).select("id", "published_at")
    out = str(tmp_path / "seen")
    append_to_parquet(first_seen(records.filter("id is not null"), "30 days").select("id"), out,
                      str(tmp_path / "state")).awaitTermination()
    assert rows(spark.read.parquet(out)) == [("1",), ("2",), ("3",)]


def test_windows_are_published_open_and_late_rows_count(spark, tmp_path):
    """Two files, the second with a row two months late; a replayed batch changes nothing."""
    events = lambda *times: spark.createDataFrame(
        [(dt.datetime.fromisoformat(t),) for t in times], "ts timestamp_ntz").coalesce(1)
    events("2025-12-01T10:05:00", "2025-12-01T10:50:00").write.parquet(str(tmp_path / "in" / "a"))
    stream = lambda: spark.readStream.schema("ts timestamp_ntz").option(
        "recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    publish_window_counts(stream(), "ts", "1 hour", out, state).awaitTermination()
    events("2025-12-01T10:59:00", "2025-10-01T10:00:00").write.parquet(str(tmp_path / "in" / "b"))
    publish_window_counts(stream(), "ts", "1 hour", out, state).awaitTermination()
    publish_window_counts(stream(), "ts", "1 hour", out, state).awaitTermination()
    got = [(r["start"].month, r["start"].hour, r["found"]) for r in read_window_counts(spark, out).orderBy("start").collect()]
    assert got == [(10, 10, 1), (12, 10, 3)]


def test_rows_behind_the_watermark_are_counted(spark, tmp_path):
    day = lambda d: dt.datetime(2025, 12, d, 10)
    source, out = tmp_path / "in", str(tmp_path / "out")
    for k, days in enumerate([(1, 20), (25,), (2, 26)]):
        spark.createDataFrame([(day(d),) for d in days], "ts timestamp_ntz").coalesce(1).write.parquet(str(source / str(k)))
        time.sleep(1.1)
    stream = spark.readStream.schema("ts timestamp_ntz").option("recursiveFileLookup", "true").option(
        "maxFilesPerTrigger", 1).parquet(str(source))
    done = append_to_parquet(window_counts(stream, "ts", "1 day", "1 day"), out, str(tmp_path / "state"))
    done.awaitTermination()
    assert rows_dropped_late(done) == 1


def test_all_late_rows_of_one_window_are_counted_and_kept(spark, tmp_path):
    """Four late rows of one window and task, in two runs, a replayed batch and a row without a time."""
    times = lambda *days: [(dt.datetime(2025, 12, d, 10) if d else None,) for d in days]
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def add(name, days):
        spark.createDataFrame(times(*days), "ts timestamp_ntz").coalesce(1).write.parquet(str(source / name))
        time.sleep(1.1)

    def run(checkpoint=state):
        stream = spark.readStream.schema("ts timestamp_ntz").option("recursiveFileLookup", "true").option(
            "maxFilesPerTrigger", 1).parquet(str(source))
        publish_closed_windows(stream, "ts", "1 day", "1 day", out, checkpoint).awaitTermination()
        return tuple(read_accounts(spark, out).first())[:3]

    add("0", (1, 20))
    add("1", (25, 25, 0))
    assert run() == (5, 0, 1)
    add("2", (2, 2, 2, 2, 26, 24))
    assert run() == (11, 4, 1)
    closed = lambda: sorted((r["start"].day, r["found"]) for r in read_closed_windows(spark, out).collect())
    assert closed() == [(1, 1), (20, 1), (24, 1)]
    assert rows(spark.read.parquet(out + "/late").select("ts")) == rows(
        spark.createDataFrame(times(2, 2, 2, 2), "ts timestamp_ntz"))
    # All batches once more, from a new checkpoint onto the same folders.
    assert run(state + "-2") == (11, 4, 1)
    assert closed() == [(1, 1), (20, 1), (24, 1)]


def test_late_rows_are_counted_beyond_the_updates_spark_keeps(spark, tmp_path):
    """More micro-batches than updates are kept, all late rows in the second one."""
    source, kept = tmp_path / "in", "spark.sql.streaming.numRecentProgressUpdates"
    source.mkdir()
    for k in range(5):
        days = ["2025-12-20"] if k != 1 else ["2025-12-01"] * 3
        (source / f"{k}.json").write_text("".join(f'{{"ts":"{d}T10:00:00"}}\n' for d in days))
        os.utime(source / f"{k}.json", (1_700_000_000 + k, 1_700_000_000 + k))
    stream = lambda: spark.readStream.schema("ts timestamp_ntz").option("maxFilesPerTrigger", 1).option(
        "maxFileAge", "10000d").json(str(source))
    out = str(tmp_path / "out")
    spark.conf.set(kept, "2")
    try:
        publish_closed_windows(stream(), "ts", "1 day", "1 day", out, str(tmp_path / "state")).awaitTermination()
        assert tuple(read_accounts(spark, out).first())[:3] == (7, 3, 0)
        done = append_to_parquet(window_counts(stream(), "ts", "1 day", "1 day"), str(tmp_path / "closed"),
                                 str(tmp_path / "closed-state"))
        done.awaitTermination()
        with pytest.raises(ValueError, match="publish_closed_windows"):
            rows_dropped_late(done)
    finally:
        spark.conf.unset(kept)


def test_ids_later_than_any_delay_are_first_seen_once(spark, tmp_path):
    """An id whose first row comes months late, repeats across files, a null id, a replayed batch."""
    source, out = tmp_path / "in", str(tmp_path / "seen")
    source.mkdir()
    files = [[("1", "2025-12-20"), ("1", "2025-12-21"), (None, "2025-12-20")], [("2", "2025-12-25")],
             [("late", "2025-06-01"), ("1", "2025-12-26"), (None, "2025-12-26")]]
    for k, lines in enumerate(files):
        (source / f"{k}.json").write_text("".join(
            json.dumps({"id": i, "published_at": f"{d}T10:00:00+0000"}) + "\n" for i, d in lines))
        os.utime(source / f"{k}.json", (1_700_000_000 + k, 1_700_000_000 + k))
    stream = lambda: spark.readStream.schema("id string, published_at string").option(
        "maxFilesPerTrigger", 1).option("maxFileAge", "10000d").json(str(source))
    for checkpoint in ("state", "state", "replay"):
        publish_first_seen(stream(), out, str(tmp_path / checkpoint)).awaitTermination()
        assert rows(spark.read.parquet(out).select("id")) == [("1",), ("2",), ("late",), (None,)]


def test_days_are_rewritten_when_micro_batches_have_doubled(spark, tmp_path, monkeypatch):
    """Eleven micro-batches into one day: five merges, and one more that died takes what was left."""
    merges, plain = [], ingest.merge_days

    def merge(*args, **kwargs):
        merges.append(1)
        plain(*args, **kwargs)

    monkeypatch.setattr(ingest, "merge_days", merge)
    for k in range(11):
        write(tmp_path / "in", [line("1", f"2025-12-01T{k:02}:00:00+0000", f"v{k}"),
                                line(f"x{k}", "2025-12-01T10:00:00+0000")], f"date=2025-12-01/p{k:02}.jsonl.gz")
    path, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        return stream_to_silver(scan_jsonl_stream(spark, path, max_files=1), out, state)

    run().awaitTermination()
    assert len(merges) == 5  # after 1, 2, 4 and 8 micro-batches and at the end
    assert {(r["id"], r["name"]) for r in spark.read.parquet(out).collect()} == {
        ("1", "v10"), *((f"x{k}", "n") for k in range(11))}

    # The last merge of a run is lost; the next run has no new file and merges what is left.
    write(tmp_path / "in", [line("1", "2025-12-01T11:00:00+0000", "v11")], "date=2025-12-01/p11.jsonl.gz")
    monkeypatch.setattr(ingest, "merge_days", lambda *args, **kwargs: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run()
    monkeypatch.setattr(ingest, "merge_days", merge)
    run()
    assert [r["name"] for r in spark.read.parquet(out).filter("id = '1'").collect()] == ["v11"]
    assert not os.path.exists(f"{state}/to_merge")


def test_lines_of_a_run_are_parsed_once_for_all_micro_batches(spark, tmp_path, monkeypatch):
    path = bronze(tmp_path)
    places = [str(tmp_path / p) for p in ("out", "ledger", "log", "state")]
    parses, plain = [], ingest.parsed_lines
    monkeypatch.setattr(ingest, "parsed_lines", lambda *args: parses.append(args[0].isStreaming) or plain(*args))
    stream_run(scan_lines_stream(spark, path, max_files=1), *places)
    assert len(parses) == 1
    assert {(r["id"], r["name"]) for r in spark.read.parquet(places[0]).collect()} == {
        ("1", "new"), ("2", "n"), ("3", "n")}
    assert rows(spark.read.json(f"{places[1]}/merged").select("last_batch")) == [(1,)]


@pytest.mark.parametrize("name", ["r1_stream_to_silver", "r1_logged_run"])
def test_days_of_silver_are_joined_without_a_broadcast(spark, tmp_path, name):
    """A row that comes twice, a later version, a late row of another day; a row without a url has no partner."""
    at = lambda day, hour: dt.datetime(2025, 12, day, hour)
    events = [(1, at(1, 10), 7), (1, at(1, 10), 7), (4, at(1, 11), 7), (7, at(2, 11), 7), (10, at(1, 9), 8),
              (None, at(3, 9), 9)]
    spark.createDataFrame([(e, t, u, "click", 1.5, "{}") for e, t, u in events],
                          "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
                          ).write.parquet(str(tmp_path / "events.parquet"))
    result = QUERIES[name](spark, str(tmp_path))
    assert rows(result.select("id", "url", "year", "month", "day")) == [
        ("7", "v/4", 2025, 12, 1), ("7", "v/7", 2025, 12, 2), ("8", "v/10", 2025, 12, 1)]
    # However small the files are, no side is gathered by the driver.
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
