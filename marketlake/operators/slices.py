"""Cut a time range into slices that hold no more rows than a cap.

All planners work on counts: rows are reduced to one count per (run, second) or
(root, cell) with partial counts in every task, and only that small table is
planned over.  No slice with rows is ever left out; one that cannot be cut further
is kept and flagged ``over_cap``.  Rows without a time form one slice of their own,
whose run, bounds and node are NULL.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.times import (
    MOSCOW,
    from_zone,
    in_zone,
    micros,
    of_micros,
    of_seconds,
    seconds,
    zone_day,
)
from marketlake.operators.joins import (
    HOT_ROWS,
    join_group_sizes,
    join_null_safe,
    split_hot,
)
from marketlake.session import materialize

# The planners travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DAY_SECONDS = 86_400
_NO_TIME = -(2**60)


# ---- chunks of a long range -------------------------------------------------

def chunk_windows(df: DataFrame, ts: Column, small_days: int = 15,
                  large_days: int = 30) -> DataFrame:
    """(chunk, start, end) covering the range of ``ts`` in fixed chunks.

    Chunks are ``large_days`` long when the range exceeds ``small_days``, otherwise
    ``small_days``.  Ends are exclusive: the last one lies a microsecond after the newest
    row, so every row with a time is in exactly one chunk.
    """
    span = df.agg(F.min(ts).cast("timestamp_ntz").alias("lo"), F.max(ts).cast("timestamp_ntz").alias("hi"))
    day = F.expr("interval 1 day")
    days = F.when(F.col("hi") - F.col("lo") > day * small_days, large_days).otherwise(small_days)
    step = F.make_dt_interval(days, F.lit(0), F.lit(0), F.lit(0))
    starts = F.filter(
        F.sequence(F.col("lo"), F.col("hi"), step),
        lambda s: s <= F.col("hi"),
    )
    return (
        span.select("hi", step.alias("step"), F.posexplode(starts).alias("chunk", "start"))
        .select(
            F.col("chunk").cast("bigint").alias("chunk"), "start",
            F.least(F.col("start") + F.col("step"), F.col("hi") + F.expr("interval 1 microsecond"))
            .alias("end"),
        )
    )


# ---- bisection --------------------------------------------------------------

def bisection_depth(span_seconds: int, min_seconds: int) -> int:
    """How often a span can be halved before it is shorter than the minimum."""
    return max(0, math.floor(math.log2(span_seconds / min_seconds)))


def _with_cells(df: DataFrame, ts: Column, span_seconds: int, depth: int) -> DataFrame:
    """Add ``root`` (start of the enclosing span) and ``cell`` (its finest piece).

    Integer arithmetic on microseconds; halving is then a bit shift of the cell.
    """
    span = span_seconds * 1_000_000
    return (
        df.withColumn("_us", micros(ts))
        .withColumn("_off", F.pmod("_us", F.lit(span)))
        .withColumn("cell", F.expr(f"(_off * {2**depth}L) div {span}L"))
        .withColumn("root", of_micros(F.col("_us") - F.col("_off")))
        .drop("_us", "_off")
    )


def bisect_slices(df: DataFrame, ts: Column, cap: int, span_seconds: int = DAY_SECONDS,
                  min_seconds: int = 300) -> DataFrame:
    """(root, level, node, start, end, found, over_cap): halve spans down to ``cap`` rows.

    A node is a slice when it fits the cap and its parent does not.  Counts of all
    levels come from one count per finest cell.  Rows without a time are one slice with
    a NULL root.
    """
    depth = bisection_depth(span_seconds, min_seconds)
    counted = (
        _with_cells(df.select(ts.alias("_ts")), F.col("_ts"), span_seconds, depth)
        .groupBy("root", "cell").agg(F.count(F.lit(1)).alias("n"))
    )
    cells = counted.filter("root is not null")
    timeless = counted.filter("root is null").select(
        "root", F.lit(0).cast("bigint").alias("level"), F.col("cell").alias("node"),
        F.col("root").alias("start"), F.col("root").alias("end"),
        F.col("n").alias("found"), (F.col("n") > cap).alias("over_cap"),
    )
    nodes = (
        cells.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(depth))))
        .withColumn("node", F.expr(f"shiftright(cell, {depth} - level)"))
        .groupBy("root", "level", "node").agg(F.sum("n").alias("found"))
    )
    siblings = Window.partitionBy("root", "level", F.expr("shiftright(node, 1)"))
    too_big = F.col("found") > cap
    parent_too_big = (F.col("level") == 0) | (F.sum("found").over(siblings) > cap)
    width = F.expr(f"{span_seconds * 1_000_000}L / power(2, level)")
    cut = (
        nodes.withColumn("_split", parent_too_big)
        .filter(F.col("_split") & (~too_big | (F.col("level") == depth)))
        .select(
            "root", F.col("level").cast("bigint").alias("level"), "node",
            of_micros(micros(F.col("root")) + F.ceil(F.col("node") * width)).alias("start"),
            of_micros(micros(F.col("root")) + F.ceil((F.col("node") + 1) * width)).alias("end"),
            "found", too_big.alias("over_cap"),
        )
    )
    return cut.unionByName(timeless)


def rows_in_bisect_slices(df: DataFrame, ts: Column, slices: DataFrame,
                          span_seconds: int = DAY_SECONDS, min_seconds: int = 300,
                          hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows with the ``level`` and ``node`` of their slice, by equality join on the cell.

    Every slice is spread to the finest cells it covers (at most ``2**depth`` a root),
    which turns the range join into an equality join; a slice that is over the cap
    has one cell.  Rows without a time meet the slice with a NULL root.
    """
    depth = bisection_depth(span_seconds, min_seconds)
    scale = f"shiftleft(1L, cast({depth} - level as int))"
    cells = slices.select(
        "root", "level", "node", "found",
        F.explode(F.expr(
            f"if(root is null, array(cast(null as bigint)), sequence(node * {scale}, (node + 1) * {scale} - 1))"
        )).alias("cell"),
    )
    rows = _with_cells(df, ts, span_seconds, depth)
    return join_group_sizes(rows, cells, ["root", "cell"], "found", hot_rows).drop("cell", "found")


# ---- planners that walk one run's counts ------------------------------------

@dataclass(frozen=True)
class WalkRules:
    """Step rules of the adaptive walk, in seconds."""

    first_step: float = 3600.0
    min_step: float = 60.0
    max_step: float = float(DAY_SECONDS)
    grow_below: int = 500
    shrink_above: int | None = None
    shrink_factor: float = 0.8
    reset_after_over_cap: bool = True


# Fixed values of the two walks: the daily loader and the stand-alone walker.
DAILY_WALK = WalkRules()
SPAN_WALK = WalkRules(min_step=30.0, max_step=7.0 * DAY_SECONDS, shrink_above=1500,
                      reset_after_over_cap=False)

_SLICE_SCHEMA = "first_second bigint, last_second bigint, found bigint, over_cap boolean"


class _Counts:
    """Rows between two seconds, both included, from sorted per-second counts."""

    def __init__(self, pdf: pd.DataFrame):
        pdf = pdf.sort_values("second")
        self.second = pdf["second"].to_numpy()
        self.total = np.concatenate([[0], np.cumsum(pdf["n"].to_numpy())])

    def found(self, first: int, last: int) -> int:
        lo = np.searchsorted(self.second, first, "left")
        hi = np.searchsorted(self.second, last, "right")
        return int(self.total[max(hi, lo)] - self.total[lo])


def _walk(counts: _Counts, start: int, end: int, cap: int, rules: WalkRules) -> Iterator[tuple]:
    """Windows from ``start`` up to, not including, ``end``.

    A window covers the whole seconds from floor(position) to floor(window end), and
    the next one starts a second later, so the windows neither overlap nor leave gaps.
    """
    at, step = float(start), rules.first_step
    while at < end:
        stop = min(at + step, float(end))
        first, last = math.floor(at), min(math.floor(stop), end - 1)
        found = counts.found(first, last)
        if found > cap and step > rules.min_step:
            step /= 2
            continue
        if found:
            yield first, last, found, found > cap
        at = stop + 1
        if found > cap:
            step = rules.first_step if rules.reset_after_over_cap else step
        elif found < rules.grow_below and step < rules.max_step:
            step *= 2
        elif rules.shrink_above is not None and found > rules.shrink_above:
            step *= rules.shrink_factor
        if not rules.reset_after_over_cap:
            step = min(step, rules.max_step)


def _halve_with_overlap(counts: _Counts, start: float, end: float, cap: int,
                        min_seconds: float, overlap_seconds: float) -> Iterator[tuple]:
    """Halves that reach ``overlap_seconds`` over the middle, at most a quarter span."""
    todo = [(start, end)]
    while todo:
        lo, hi = todo.pop()
        first, last = math.floor(lo), math.floor(hi)
        found = counts.found(first, last)
        if not found:
            continue
        half = (hi - lo) / 2
        over = min(overlap_seconds, half / 2)
        if found <= cap or half + over < min_seconds:
            yield first, last, found, found > cap
        else:
            mid = lo + half
            todo += [(mid - over, hi), (lo, mid + over)]


def _plan(counts: DataFrame, cap: int, planner) -> DataFrame:
    """Run a planner over each run's counts; the only Python step, on counts alone."""
    run_type = counts.schema["run"].dataType.simpleString()

    def one_run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = list(planner(_Counts(pdf), int(pdf["start"].iloc[0]), int(pdf["end"].iloc[0])))
        out = pd.DataFrame(found, columns=["first_second", "last_second", "found", "over_cap"])
        out.insert(0, "run", pdf["run"].iloc[0])
        return out

    timed = counts.filter("second is not null")
    planned = timed.groupBy("run").applyInPandas(one_run, f"run {run_type}, {_SLICE_SCHEMA}")
    none = F.lit(None).cast("bigint")
    timeless = counts.filter("second is null").groupBy().agg(F.sum("n").alias("found")).filter(
        "found is not null").select(
        F.lit(None).cast(run_type).alias("run"), none.alias("first_second"),
        none.alias("last_second"), "found", (F.col("found") > cap).alias("over_cap"),
    )
    return planned.unionByName(timeless).withColumn(
        "start", of_seconds(F.col("first_second"))
    ).withColumn("end", of_seconds(F.col("last_second")))


def second_counts(df: DataFrame, utc: Column, run: Column, start: Column,
                  end: Column) -> DataFrame:
    """(run, second, start, end, n): counts a second, with the second each run begins at
    and the second it ends before.

    ``start`` and ``end`` are UTC times of the run's bounds.  Rows without a time are
    counted under a NULL second.
    """
    return (
        df.select(run.alias("run"), seconds(utc).alias("second"), seconds(start).alias("start"),
                  seconds(end).alias("end"))
        .groupBy("run", "second", "start", "end").agg(F.count(F.lit(1)).alias("n"))
    )


def daily_second_counts(df: DataFrame, utc: Column, zone: str = MOSCOW) -> DataFrame:
    """Counts of calendar days of ``zone``, which may last 23 or 25 hours."""
    day = zone_day(utc, zone)
    return second_counts(
        df, utc, day, from_zone(day.cast("timestamp_ntz"), zone),
        from_zone(F.date_add(day, 1).cast("timestamp_ntz"), zone),
    )


def weekly_second_counts(df: DataFrame, utc: Column, zone: str = MOSCOW) -> DataFrame:
    """Counts of weeks of ``zone`` from Monday on, the unit of the long walk.

    A walk is sequential, so its unit is bounded: 604 800 seconds, give or take an hour.
    """
    week = F.to_date(F.date_trunc("week", in_zone(utc, zone)))
    return second_counts(
        df, utc, week, from_zone(week.cast("timestamp_ntz"), zone),
        from_zone(F.date_add(week, 7).cast("timestamp_ntz"), zone),
    )


def walk_slices(counts: DataFrame, cap: int = 2000, rules: WalkRules = DAILY_WALK) -> DataFrame:
    """Adaptive walk over each run: (run, first_second, last_second, found, over_cap, start, end)."""
    return _plan(counts, cap, lambda c, start, end: _walk(c, start, end, cap, rules))


def overlapping_slices(counts: DataFrame, cap: int = 2000, min_seconds: int = 300,
                       overlap_seconds: int = 300) -> DataFrame:
    """Recursive halves that overlap around the cut; rows near a cut are in both."""
    return _plan(
        counts, cap,
        lambda c, start, end: _halve_with_overlap(
            c, start, end - 1, cap, min_seconds, overlap_seconds
        ),
    )


def rows_in_slices(df: DataFrame, utc: Column, run: Column, slices: DataFrame,
                   grid_seconds: int = 60, salts: int = 8) -> DataFrame:
    """Rows with the slice(s) they fall in; rows without a time meet the timeless slice.

    Slices are spread to the grid steps they touch, so the range join becomes an
    equality join on (run, step) with the exact bounds checked inside it.  There are
    about 1 440 one-minute steps a day, whatever the number of rows; every step is
    repeated ``salts`` times and the rows of a busy minute are dealt over the copies.
    """
    def step(second: Column) -> Column:
        return F.coalesce(F.floor(second / grid_seconds), F.lit(_NO_TIME))

    first, last = F.col("first_second"), F.col("last_second")
    by_step = slices.select(
        F.col("run").alias("_run"), "first_second", "last_second", "over_cap",
        F.explode(F.sequence(step(first), step(last))).alias("_at"),
    ).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    plain = [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, T.MapType)]
    rows = df.withColumns({"run": run, "_second": seconds(utc),
                           "_salt": F.pmod(F.xxhash64(*plain), F.lit(salts)).cast("int")})
    inside = (
        F.col("run").eqNullSafe(F.col("_run"))
        & (step(F.col("_second")) == F.col("_at")) & (F.col("_salt") == F.col("_copy"))
        & (F.col("first_second").isNull() | F.col("_second").between(first, last))
    )
    return rows.join(by_step, inside).drop("_run", "_at", "_second", "_salt", "_copy")


# ---- beyond time: dimensions, caps and pages --------------------------------

def drill_slices(df: DataFrame, slice_keys: list[str], dims: dict[str, Column],
                 cap: int) -> DataFrame:
    """Cut over-cap slices by further dimensions, one after the other.

    Returns (slice_keys, dims, depth, found, over_cap): ``depth`` dimensions are used,
    as few as bring the slice under the cap; deeper ones are NULL.  A NULL value is a
    bucket of its own, so every row is in exactly one result row.  Multi-valued
    dimensions are exploded by the caller.
    """
    names = list(dims)
    found = (
        df.select(*slice_keys, *[c.alias(n) for n, c in dims.items()])
        .groupBy(*slice_keys, *names).agg(F.count(F.lit(1)).alias("n"))
    )
    depth = F.lit(len(names))
    for i in reversed(range(len(names))):
        fits = F.sum("n").over(Window.partitionBy(*slice_keys, *names[:i])) <= cap
        depth = F.when(fits, F.lit(i)).otherwise(depth)
    drilled = found.withColumn("depth", depth.cast("bigint"))
    used = [F.when(F.col("depth") > i, F.col(n)).alias(n) for i, n in enumerate(names)]
    return (
        drilled.groupBy(*slice_keys, *used, "depth")
        .agg(F.sum("n").alias("found"))
        .withColumn("over_cap", F.col("found") > cap)
    )


def flag_beyond_cap(df: DataFrame, keys: list[str], cap: int, ts: Column, key: Column) -> DataFrame:
    """All rows, with ``found`` of their slice and ``beyond_cap`` for those after the first ``cap``.

    This is the reporting form of a hard service limit: what the limit would hide is
    marked, and no row is left out.
    """
    found = materialize(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("found")), "found")
    numbered = number_rows(df, keys, ts, key)
    return join_null_safe(numbered, found, keys).withColumn("beyond_cap", F.col("rn") > cap).drop("rn")


def number_rows(df: DataFrame, keys: list[str], ts: Column, key: Column,
                hash_chars: int = 3, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``rn``, the row's 1-based position in its group by (second, hashed key).

    Groups may be of any size; ``key`` should identify a row.  Groups up to
    ``hot_rows`` are ranked by an ordinary window.  Rows of larger ones are ranked
    only inside (second, first hash characters), and each such bin starts at the
    number of rows in the days, seconds and bins before it.
    """
    # Rows without a time come first, rows without a key first in their second, by their content.
    row_text = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    ordered = df.withColumns({
        "_sec": F.coalesce(seconds(ts), F.lit(_NO_TIME)),
        "_hash": F.coalesce(F.md5(key.cast("string")), F.concat(F.lit(" "), row_text)),
    })
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    hot, rest = split_hot(ordered, sizes, keys, "_size", hot_rows)
    in_group = Window.partitionBy(*keys).orderBy("_sec", "_hash", key)
    ranked = rest.withColumn("rn", F.row_number().over(in_group).cast("bigint"))
    return ranked.unionByName(_number_in_bins(hot, keys, key, hash_chars)).drop("_sec", "_hash")


def _number_in_bins(ordered: DataFrame, keys: list[str], key: Column,
                    hash_chars: int) -> DataFrame:
    """``rn`` by ranks inside small bins plus the rows counted before each bin.

    The counts are summed level by level, so that no window spans more than a
    group's days, a day's seconds or a second's bins.
    """
    levels = ["_day", "_sec", "_bin"]
    binned = ordered.withColumns({
        "_day": F.floor(F.col("_sec") / DAY_SECONDS), "_bin": F.substring("_hash", 1, hash_chars),
    })
    bins = binned.groupBy(*keys, *levels).agg(F.count(F.lit(1)).alias("_n"))
    offsets = bins.withColumn("_from", F.lit(0).cast("bigint")).drop("_n")
    for i, level in enumerate(levels):
        inside, upto = [*keys, *levels[:i]], [*keys, *levels[:i + 1]]
        before = Window.partitionBy(*inside).orderBy(level).rowsBetween(
            Window.unboundedPreceding, -1
        )
        per_part = bins.groupBy(*upto).agg(F.sum("_n").alias("_n")).select(
            *upto, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
        )
        offsets = join_null_safe(
            offsets, per_part, keys, never_null=tuple(levels[:i + 1])
        ).withColumn("_from", F.col("_from") + F.col("_before")).drop("_before")
    in_bin = Window.partitionBy(*keys, *levels).orderBy("_hash", key)
    return (
        join_null_safe(binned, offsets, keys, never_null=tuple(levels))
        .withColumn("rn", (F.row_number().over(in_bin) + F.col("_from")).cast("bigint"))
        .drop("_day", "_bin", "_from")
    )


def with_pages(df: DataFrame, keys: list[str], ts: Column, key: Column, per_page: int = 100,
               hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``rn`` and the 0-based ``page`` of each row inside its slice."""
    numbered = number_rows(df, keys, ts, key, hot_rows=hot_rows)
    return numbered.withColumn("page", F.floor((F.col("rn") - 1) / per_page).cast("bigint"))


def page_plan(found: DataFrame, per_page: int = 100) -> DataFrame:
    """One row a page: ``pages`` is ``ceil(found / per_page)``; an empty slice has none."""
    pages = F.ceil(F.col("found") / per_page).cast("bigint")
    return found.withColumn("pages", pages).filter("pages > 0").withColumn(
        "page", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pages") - 1))
    )
