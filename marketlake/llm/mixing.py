"""Mixing sources to target weights by hash-threshold histograms.

Every row has a fixed hash.  Its source takes all rows a whole number of times and, once
more, the rows whose hash lies under a threshold.  The threshold is found from sums of
sizes by source and hash bucket: only the bucket in which the budget runs out is split
further, until it holds one hash value.  Nothing is sorted, a larger budget always takes
a superset of a smaller one, and reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.joins import join_null_safe
from marketlake.session import materialize
from marketlake.llm.numbering import numbered, with_sums_before

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS, LEVEL_BITS = 60, 12
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3


def _size() -> Column:
    return F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")


def _mark() -> Column:
    """60 bits of the MD5 of id and text; equal rows have equal marks."""
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                     F.coalesce("text", F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, 15), 16, 10).cast("long")


def targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, weight, target): one row a source, a null source last.

    Sources in code point order weigh 1, 2, 3, repeating.  All sizes are shared out by
    weight; a source that would exceed three times its size stops there, and the excess
    goes to the others.  In order of cap by weight, the first source that the remaining
    share does not fill ends the capped ones, which is where resharing round by round ends.
    """
    by_name = sized.groupBy("source").agg(F.sum("size").alias("source_size")).select(
        F.lit(0).alias("all"), F.col("source").isNull().alias("is_null"), "source", "source_size")
    ranked = numbered(materialize(by_name, "sources"), "all", ["is_null", "source"])
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("pos") % len(WEIGHTS) + 1).cast("int"))
    caps = ranked.select("source", "source_size", F.col("pos").alias("place"), weight.cast("long").alias("weight"),
                         (F.col("source_size") * MOST_COPIES).alias("cap"))
    caps = materialize(caps.withColumn("full", F.col("cap") / F.col("weight")), "caps")
    total = caps.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight"))
    left = materialize(
        with_sums_before(caps, ["full", "place"], ["cap", "weight"])
        .withColumn("share", (total.select("size").scalar() - F.col("cap_before"))
                    / (total.select("weight").scalar() - F.col("weight_before"))), "shares")
    # The first source in this order that the share does not fill; none if all are full.
    first = left.filter(F.col("full") >= F.col("share")).agg(F.min(F.struct("step", "share")).alias("f"))
    return left.withColumn("first", first.scalar()).select(
        "source", "source_size", "weight",
        F.when(F.col("first").isNull() | (F.col("step") < F.col("first.step")), F.col("cap").cast("double"))
        .otherwise(F.col("first.share") * F.col("weight")).alias("target"))


def thresholds(sized: DataFrame) -> DataFrame:
    """(source, source_size, target, copies, cut, cut_taken): what decides every row.

    A row is taken ``copies`` times, and once more with a mark under ``cut``, or at it
    where ``cut_taken``.  The rows at the cut are taken if that comes nearer the target.
    """
    whole = F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MOST_COPIES)).cast("long")
    goal = targets(sized).withColumn(
        "copies", F.when(F.col("source_size") > 0, whole).otherwise(F.lit(0).cast("long")))
    goal = goal.withColumn("budget", F.col("target") - F.col("copies") * F.col("source_size"))
    # ``low`` and ``high`` enclose the marks still open, ``before`` sums the sizes below them.
    state = materialize(goal.withColumns({
        "low": F.lit(0).cast("long"), "high": F.lit((1 << HASH_BITS) - 1).cast("long"),
        "before": F.lit(0).cast("long"), "inside": F.col("source_size"),
        "done": (F.col("budget") <= 0) | (F.col("source_size") == 0),
    }), "mix")
    columns = state.columns
    shift = HASH_BITS
    while shift > 0 and not state.filter(~F.col("done")).isEmpty():
        shift -= LEVEL_BITS
        open_ = state.filter(~F.col("done"))
        rows = join_null_safe(sized, open_.select("source", "low", "high"), ["source"])
        rows = rows.filter(F.col("mark").between(F.col("low"), F.col("high")))
        buckets = rows.groupBy("source", F.shiftright("mark", shift).alias("bucket")).agg(
            F.sum("size").alias("size"), F.min("mark").alias("least"), F.max("mark").alias("most"))
        up_to = Window.partitionBy("source").orderBy("bucket")
        summed = buckets.withColumn("upto", F.sum("size").over(up_to))
        found = join_null_safe(
            summed, open_.select("source", "budget", F.col("before").alias("base")), ["source"])
        over = found.filter(F.col("base") + F.col("upto") > F.col("budget")).groupBy("source").agg(
            F.min(F.struct("bucket", "least", "most", "size", "upto")).alias("b"))
        refined = join_null_safe(state, over, ["source"], "left").select(
            *[c for c in columns if c not in ("low", "high", "before", "inside", "done")],
            F.coalesce("b.least", "low").alias("low"), F.coalesce("b.most", "high").alias("high"),
            (F.col("before") + F.coalesce(F.col("b.upto") - F.col("b.size"), F.lit(0))).alias("before"),
            F.coalesce("b.size", "inside").alias("inside"),
            (F.col("done") | F.col("b").isNull() | (F.col("b.least") == F.col("b.most"))).alias("done"),
        )
        state = materialize(refined, "mix")
    nothing = (F.col("budget") <= 0) | (F.col("source_size") == 0)
    return state.select(
        "source", "source_size", "target", "copies",
        F.when(nothing, F.lit(-1).cast("long")).otherwise(F.col("low")).alias("cut"),
        (~nothing & (2 * F.col("before") + F.col("inside") <= 2 * F.col("budget"))).alias("cut_taken"))


def _take(rows: DataFrame, limits: DataFrame) -> DataFrame:
    joined = join_null_safe(rows, limits, ["source"])
    extra = (F.col("mark") < F.col("cut")) | ((F.col("mark") == F.col("cut")) & F.col("cut_taken"))
    times = F.col("copies") + extra.cast("long")
    return joined.withColumn("times", F.when(F.col("size") > 0, times).otherwise(F.lit(0).cast("long")))


def sized_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, mark), written once; all later passes read only this."""
    return materialize(docs.select("doc_id", "source", _size().alias("size"), _mark().alias("mark")), "sizes")


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken): words of each row that the mix takes.

    A null or empty text has size 0 and is not taken.  Rows equal in id and text share
    one mark and are taken alike.  Columns other than doc_id, text and source are ignored.
    """
    sized = sized_rows(docs)
    return _take(sized, thresholds(sized)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that the mix takes, with ``mix_copies``: how often each is read.

    Thresholds come from the sizes; rows are then judged where they are read, so no text
    is shuffled.  A column of ``docs`` named ``mix_copies`` is replaced.
    """
    limits = thresholds(sized_rows(docs))
    kept = [c for c in docs.columns if c != "mix_copies"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col("source").alias("source"),
                       _size().alias("size"), _mark().alias("mark"))
    return _take(rows, limits).filter("times > 0").select("row.*", F.col("times").alias("mix_copies"))


SQL = r"""with d as (
 select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
  ('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || coalesce(text, '')), 1, 15))::bigint as mark
 from documents
), s as (
 select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) as place
 from d group by source
), w as (
 select *, (place - 1) % 3 + 1 as weight, source_size * 3 as cap from s
), o as (
 select *, sum(source_size) over () - coalesce(sum(cap) over (order by cap / weight, place
   rows between unbounded preceding and 1 preceding), 0) as rest,
  sum(weight) over () - coalesce(sum(weight) over (order by cap / weight, place
   rows between unbounded preceding and 1 preceding), 0) as weights,
  row_number() over (order by cap / weight, place) as step from w
), f as (
 select min(step) as step, arg_min(cast(rest as double) / cast(weights as double), step) as share
 from o where cap / weight >= cast(rest as double) / cast(weights as double)
), t as (
 select source, source_size, case when f.step is null or o.step < f.step then cast(cap as double)
  else share * weight end as target from o cross join f
), g as (
 select t.*, case when source_size > 0 then cast(least(floor(target / source_size), 3) as bigint) else 0 end as copies
 from t
), m as (
 select source, mark, sum(size) as size from d group by all
), c as (
 select source, mark, size, sum(size) over (partition by source order by mark) as upto from m
)
select d.doc_id, cast(d.size as bigint) as size, g.source_size, g.target,
 cast(case when d.size = 0 then 0 else d.size * (g.copies + case when g.target - g.copies * g.source_size > 0
  and 2 * c.upto - c.size <= 2 * (g.target - g.copies * g.source_size) then 1 else 0 end) end as bigint) as taken
from d join g on d.source is not distinct from g.source
join c on d.source is not distinct from c.source and d.mark = c.mark"""
