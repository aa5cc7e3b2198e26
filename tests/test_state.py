import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marketlake.session import scratch_path
from marketlake.streaming.state import open_windows, publish_first_rows, publish_watermarked_windows, published_windows

START = dt.datetime(2024, 1, 1)


def run(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def test_first_rows_are_whole_and_late_ids_stay(spark):
    base, path, state = (scratch_path(spark, x) for x in ("in", "out", "state"))
    rng = random.Random(1)
    seen, first = set(), {}
    for k in range(3):
        rows = [(rng.randint(0, 40) if rng.random() < 0.6 else None if rng.random() < 0.1 else 7, f"{k}-{n}",
                 START - dt.timedelta(days=100 * k)) for n in range(200)]
        rows.append((1000 + k, f"{k}-late", START - dt.timedelta(days=5000)))
        for i, v, t in rows:
            if i not in seen:
                first.setdefault(i, set()).add((v, t))
        seen |= {r[0] for r in rows}
        spark.createDataFrame(rows, "id long, v string, t timestamp_ntz").write.mode("append").parquet(base)
        stream = spark.readStream.schema("id long, v string, t timestamp_ntz").parquet(base)
        run(publish_first_rows(stream, path, state, state_partitions=2))
    found = spark.read.parquet(path).collect()
    assert len(found) == len(first) and None in first
    assert all((r.v, r.t) in first[r.id] for r in found)


def test_a_micro_batch_touches_its_own_keys_only(spark):
    base, path, state = (scratch_path(spark, x) for x in ("in", "out", "state"))
    spark.range(50 * 400).withColumn("id", F.concat(F.lit("key-"), "id")).repartition(50).write.parquet(base)
    stream = spark.readStream.schema("id string").option("maxFilesPerTrigger", 1).parquet(base)
    query = run(publish_first_rows(stream, path, state, state_partitions=1))
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(progress) == 50 and spark.read.parquet(path).count() == 20_000

    def work(p, what):
        return sum(int(op["customMetrics"][what]) for op in p["stateOperators"])

    for what in ("rocksdbTotalBytesRead", "rocksdbTotalBytesWritten", "rocksdbBytesCopied"):
        each = [work(p, what) for p in progress]
        assert max(each[-10:]) <= 3 * max(max(each[5:15]), 1000), (what, each)


@pytest.mark.parametrize("salts", [1, 3])
def test_windows_close_once_and_late_rows_come_out_whole(spark, salts):
    base, path, state = (scratch_path(spark, x) for x in ("in", "out", "state"))
    rng = random.Random(salts)
    hour, delay = dt.timedelta(hours=1), dt.timedelta(hours=2)
    closed, late, whole, mark, n = {}, {}, set(), None, 0
    for k in range(4):
        rows = []
        for _ in range(60):
            t = START + dt.timedelta(minutes=rng.randint(240 * k, 240 * k + 300) - (600 if rng.random() < 0.2 else 0))
            rows.append((n := n + 1, None if rng.random() < 0.1 else t, rng.choice(["a", "b", None])))
        for i, t, kind in rows:
            if t is None:
                continue
            end = t.replace(minute=0) + hour
            group = late if mark is not None and end <= mark else closed
            group[end, kind] = group.get((end, kind), 0) + 1
            if group is late:
                whole.add(i)
        newest = max(t for _, t, _ in rows if t) - delay
        mark = newest if mark is None else max(mark, newest)
        spark.createDataFrame(rows, "id long, t timestamp_ntz, kind string").write.mode("append").parquet(base)
        stream = spark.readStream.schema("id long, t timestamp_ntz, kind string").parquet(base)
        run(publish_watermarked_windows(stream, "t", "1 hour", "2 hours", path, state, ["kind"], salts, 2))
    found = {(r.end, r.kind): (r.closed, r.late) for r in published_windows(spark, path, ["kind"]).collect()}
    want = {w: (closed.get(w, 0) if w[0] <= mark else 0, late.get(w, 0)) for w in {**closed, **late}}
    assert found == {w: x for w, x in want.items() if x != (0, 0)}
    still = {(r.end, r.kind): r.open for r in open_windows(spark, state, ["kind"]).collect()}
    assert still == {w: x for w, x in closed.items() if w[0] > mark}
    out = spark.read.parquet(path).filter("late_row is not null").select(F.get_json_object("late_row", "$.id").cast("long")).collect()
    assert late and {r[0] for r in out} == whole
