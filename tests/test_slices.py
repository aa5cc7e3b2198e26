"""Slice planners against brute force, on skewed counts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marketlake.functions.times import zone_day
from marketlake.operators.slices import (
    DAILY_WALK,
    SPAN_WALK,
    bisect_slices,
    chunk_windows,
    daily_second_counts,
    drill_slices,
    flag_beyond_cap,
    number_rows,
    overlapping_slices,
    page_plan,
    rows_in_bisect_slices,
    rows_in_slices,
    walk_slices,
    weekly_second_counts,
    with_pages,
)
from marketlake.plans.harvest import batch_rows

CAP = 20


@pytest.fixture(scope="module")
def events(spark):
    """Three days; a third of all rows in one second, one empty stretch, edge instants."""
    rnd = random.Random(7)
    start = dt.datetime(2024, 3, 1)
    stamps = [start + dt.timedelta(seconds=rnd.random() * 3 * 86400) for _ in range(600)]
    stamps = [t for t in stamps if not dt.datetime(2024, 3, 2, 3) < t < dt.datetime(2024, 3, 2, 15)]
    stamps += [dt.datetime(2024, 3, 2, 20, 0, 0, i) for i in range(300)]
    stamps += [start, dt.datetime(2024, 3, 1, 20, 59, 59, 999999), dt.datetime(2024, 3, 1, 21)]
    data = [(i, t, rnd.choice(["a", "b", None]), rnd.choice([0, 1, None])) for i, t in enumerate(stamps)]
    return spark.createDataFrame(data, "id long, ts timestamp_ntz, kind string, bucket int")


def counts(df):
    return daily_second_counts(df, F.col("ts"))


@pytest.mark.parametrize("rules", [DAILY_WALK, SPAN_WALK])
def test_walk_covers_every_row_once(events, rules):
    slices = walk_slices(counts(events), CAP, rules)
    total = events.count()
    assert slices.agg(F.sum("found")).first()[0] == total
    assert slices.filter((F.col("found") > CAP) & ~F.col("over_cap")).count() == 0
    assert slices.filter("over_cap").count() >= 1
    rows = rows_in_slices(events, F.col("ts"), zone_day(F.col("ts")), slices)
    assert rows.count() == rows.select("id").distinct().count() == total


def test_overlapping_halves_lose_nothing(events):
    slices = overlapping_slices(counts(events), CAP)
    rows = rows_in_slices(events, F.col("ts"), zone_day(F.col("ts")), slices)
    assert rows.select("id").distinct().count() == events.count()
    assert rows.count() > events.count()
    assert slices.filter((F.col("found") > CAP) & ~F.col("over_cap")).count() == 0


def test_bisection_matches_recursion(events):
    stamps = sorted(r["ts"] for r in events.select("ts").collect())

    def halve(lo, hi):
        n = sum(lo <= t < hi for t in stamps)
        if n == 0:
            return []
        if n <= CAP or (hi - lo) / 2 < dt.timedelta(minutes=5):
            return [(lo, hi, n, n > CAP)]
        mid = lo + (hi - lo) / 2
        return halve(lo, mid) + halve(mid, hi)

    want = []
    for d in range(3):
        lo = dt.datetime(2024, 3, 1) + dt.timedelta(days=d)
        want += halve(lo, lo + dt.timedelta(days=1))
    slices = bisect_slices(events, F.col("ts"), CAP)
    got = sorted(tuple(r) for r in slices.select("start", "end", "found", "over_cap").collect())
    assert got == sorted(want)
    for hot in (0, 100, 1000):
        rows = rows_in_bisect_slices(events, F.col("ts"), slices, hot_rows=hot)
        sizes = rows.groupBy("root", "level", "node").agg(F.count(F.lit(1)).alias("n"))
        assert rows.count() == len(stamps)
        assert sizes.join(slices, ["root", "level", "node"]).filter("n <> found").count() == 0


def test_rows_without_a_time_are_a_slice_of_their_own(spark, events):
    odd = events.union(spark.sql("select 9990L + id, cast(null as timestamp_ntz), 'a', 1 from range(30)"))
    total = events.count() + 30
    bisected = bisect_slices(odd, F.col("ts"), CAP)
    assert bisected.agg(F.sum("found")).first()[0] == total
    assert rows_in_bisect_slices(odd, F.col("ts"), bisected).count() == total
    walked = walk_slices(counts(odd), CAP)
    assert walked.agg(F.sum("found")).first()[0] == total
    timeless = walked.filter("run is null").collect()
    assert [(r["found"], r["over_cap"], r["start"]) for r in timeless] == [(30, True, None)]
    rows = rows_in_slices(odd, F.col("ts"), zone_day(F.col("ts")), walked)
    assert rows.count() == rows.select("id").distinct().count() == total
    out = batch_rows(odd, F.col("ts"), F.col("id"), {"kind": F.col("kind")}, CAP, per_page=7)
    assert out.count() == total and out.filter("run is null").count() == 30


@pytest.mark.parametrize("day,hours", [(dt.date(2014, 10, 26), 25), (dt.date(2011, 3, 27), 23), (dt.date(2024, 1, 5), 24)])
def test_days_of_23_and_25_hours_are_whole(spark, day, hours):
    """Every ten minutes of a Moscow day around a change of its offset."""
    noon = dt.datetime.combine(day, dt.time(9))
    stamps = [noon + dt.timedelta(minutes=10 * k) for k in range(-144, 145)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(stamps)], "id long, ts timestamp_ntz")
    df = df.filter(zone_day(F.col("ts")) == F.lit(day))
    assert df.count() == 6 * hours
    for slices in (walk_slices(counts(df), CAP), overlapping_slices(counts(df), CAP),
                   walk_slices(weekly_second_counts(df, F.col("ts")), CAP, SPAN_WALK)):
        run = zone_day(F.col("ts")) if slices.first()["run"] == day else F.lit(slices.first()["run"])
        rows = rows_in_slices(df, F.col("ts"), run, slices)
        assert rows.select("id").distinct().count() == 6 * hours
    assert walk_slices(counts(df), CAP).agg(F.sum("found")).first()[0] == 6 * hours
    out = batch_rows(df, F.col("ts"), F.col("id"), {}, CAP, per_page=7)
    assert out.count() == 6 * hours


def test_drill_keeps_null_buckets(events):
    df = events.withColumn("day", F.to_date("ts"))
    out = drill_slices(df, ["day"], {"kind": F.col("kind"), "bucket": F.col("bucket")}, 100)
    assert out.agg(F.sum("found")).first()[0] == events.count()
    assert out.filter((F.col("found") > 100) & (F.col("depth") < 2)).count() == 0
    assert out.filter("depth = 1 and kind is null").count() >= 1


@pytest.mark.parametrize("hot_rows", [0, 250, 1000])
def test_number_rows_is_a_permutation_even_for_null_groups(events, hot_rows):
    out = number_rows(events, ["kind"], F.col("ts"), F.col("id"), hot_rows=hot_rows)
    assert out.count() == events.count()
    per = {}
    for r in out.collect():
        per.setdefault(r["kind"], []).append((r["rn"], r["ts"].replace(microsecond=0)))
    for group in per.values():
        group.sort()
        assert [rn for rn, _ in group] == list(range(1, len(group) + 1))
        seconds = [s for _, s in group]
        assert seconds == sorted(seconds)


def test_pages_hold_each_row_once(events):
    out = with_pages(events.withColumn("day", F.to_date("ts")), ["day"], F.col("ts"), F.col("id"), 10)
    sizes = out.groupBy("day", "page").count()
    assert sizes.agg(F.max("count"), F.sum("count")).first() == (10, events.count())


def test_rows_beyond_a_hard_cap_are_marked(events):
    df = events.withColumn("day", F.to_date("ts"))
    out = flag_beyond_cap(df, ["day"], 50, F.col("ts"), F.col("id")).collect()
    assert len(out) == df.count()
    for day in {r["day"] for r in out}:
        mine = [r for r in out if r["day"] == day]
        kept = [r for r in mine if not r["beyond_cap"]]
        assert len(kept) == min(50, len(mine)) and {r["found"] for r in mine} == {len(mine)}
        second = lambda r: r["ts"].replace(microsecond=0)
        rest = [second(r) for r in mine if r["beyond_cap"]]
        assert not rest or max(map(second, kept)) <= min(rest)


def test_page_plan_covers_all_rows(spark):
    found = spark.createDataFrame([(0, 0), (1, 1), (2, 100), (3, 101), (4, 5000)], "k int, found long")
    got = {r["k"]: (r["n"], r["lo"]) for r in page_plan(found).groupBy("k").agg(
        F.count("*").alias("n"), F.min("page").alias("lo")).collect()}
    assert got == {1: (1, 0), 2: (1, 0), 3: (2, 0), 4: (50, 0)}


def test_chunks_choose_their_length(spark):
    def chunks(days):
        df = spark.createDataFrame(
            [(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 1) + dt.timedelta(days=days),)],
            "ts timestamp_ntz")
        return [(r["start"].day, (r["end"] - r["start"]).days)
                for r in chunk_windows(df, F.col("ts")).orderBy("chunk").collect()]

    assert chunks(10) == [(1, 10)]
    assert chunks(15) == [(1, 15), (16, 0)]
    assert chunks(70)[0] == (1, 30) and sum(n for _, n in chunks(70)) == 70  # and a microsecond


def test_batches_keep_every_row(events):
    out = batch_rows(events, F.col("ts"), F.col("id"),
                     {"kind": F.col("kind"), "bucket": F.col("bucket")}, CAP, per_page=7)
    assert out.count() == out.select("id").distinct().count() == events.count()
    unit = ["run", "first_second", "dim_kind", "dim_bucket", "page"]
    assert out.groupBy(*unit).count().agg(F.max("count")).first()[0] <= 7
