"""Deletion of repeated line runs, from a suffix array over line ids.

A document is a sequence of line ids.  Prefix doubling ranks all its suffixes by their
first 1, 2, 4, ... lines: in each round the pair (own rank, rank 2^k lines on) is sorted
and numbered.  Suffixes of one rank form an interval of the suffix array whose longest
common prefix is at least 2^k lines; two such prefixes that overlap decide whether two
windows of any length in between are equal.  Only lines that occur twice take part, and
a suffix drops out once no other one shares its prefix, so rounds shrink quickly.

A run is repeated text if it has at least ``min_words`` words.  Every repeated run is
the union of its shortest windows with that many words, seen from each first and from
each last line, so it is enough to compare those windows: that is exact, and bounds the
doubling by the longest such window.  All but the first of equal windows are later
copies; their lines, merged into maximal runs, are deleted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.session import materialize

MIN_WORDS = 50
WORD = r"[^\x20\x09-\x0D]+"
#: A sequence is a document id with a hash of its text; a null id sorts last.
_SEQ = ["late", "doc_id", "text_hash"]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", "text", F.col("doc_id").isNull().alias("late"), F.xxhash64("text").alias("text_hash"))


def line_table(docs: DataFrame) -> DataFrame:
    r"""(seq, pos, id, words): the lines between \n of every text, and an end mark (null id)."""
    exploded = _keyed(docs).filter("text is not null").select(
        *_SEQ, F.posexplode(F.concat(F.split("text", "\n"), F.array(F.lit(None).cast("string"))))
        .alias("pos", "line"))
    return exploded.select(
        *_SEQ, "pos", F.unhex(F.md5("line")).alias("id"),
        F.coalesce(F.regexp_count("line", F.lit(WORD)), F.lit(0)).alias("words"))


def _repeated_ids(lines: DataFrame) -> DataFrame:
    """Line ids at two places at least, numbered in order of the id."""
    place = F.struct(*_SEQ, "pos")
    twice = lines.filter("id is not null").groupBy("id").agg(
        F.min(place).alias("least"), F.max(place).alias("most")).filter("least <> most")
    return twice.select("id").orderBy("id").withColumn("rank", F.monotonically_increasing_id())


def _windows(lines: DataFrame, min_words: int) -> DataFrame:
    """(seq, start, length) of the shortest windows of repeated lines with ``min_words`` words.

    ``lines`` holds (seq, pos, rank, words), the rank null for a line that occurs once
    and for the end mark.  ``c`` counts the words before a line and ``u`` the unrepeated
    lines, so a window is [start, end) with c grown by ``min_words`` and u unchanged.
    """
    by_pos = Window.partitionBy(*_SEQ).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    counted = lines.groupBy(*_SEQ, "pos").agg(F.max("rank").alias("rank"), F.max("words").alias("words"))
    counted = counted.withColumns({
        "c": F.coalesce(F.sum("words").over(by_pos), F.lit(0)),
        "u": F.coalesce(F.sum(F.col("rank").isNull().cast("int")).over(by_pos), F.lit(0)),
    })
    # kind 1: boundaries; 0 and 2: a window wanted from this start, or up to this end.
    marks = counted.select(*_SEQ, "pos", "u", F.explode(F.array(
        F.struct(F.lit(1).alias("kind"), F.col("c").cast("long").alias("at")),
        F.struct(F.lit(0).alias("kind"), (F.col("c") + min_words).cast("long").alias("at")),
        F.struct(F.lit(2).alias("kind"), (F.col("c") - min_words).cast("long").alias("at")),
    )).alias("m")).select(*_SEQ, "pos", "u", "m.kind", "m.at")
    boundary = F.when(F.col("kind") == 1, F.struct("pos", "u"))
    seq = Window.partitionBy(*_SEQ)
    # Boundaries stand before queries of the same word count; the nearest is the last one met.
    down = seq.orderBy(F.col("at").desc(), (F.col("kind") != 1).asc(), F.col("pos").desc())
    up = seq.orderBy(F.col("at").asc(), (F.col("kind") != 1).asc(), F.col("pos").asc())
    found = marks.withColumns({
        "end": F.last(boundary, ignorenulls=True).over(
            down.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "start": F.last(boundary, ignorenulls=True).over(
            up.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    })
    both = F.when(F.col("kind") == 0, F.struct(
        F.col("pos").alias("start"), (F.col("end.pos") - F.col("pos")).alias("length"), F.col("end.u").alias("u")))
    both = both.otherwise(F.struct(
        F.col("start.pos").alias("start"), (F.col("pos") - F.col("start.pos")).alias("length"),
        F.col("start.u").alias("u")))
    return found.filter("kind <> 1").select(*_SEQ, "u", both.alias("w")).filter("w.u = u").select(
        *_SEQ, "w.start", "w.length").distinct()


def _double(ranks: DataFrame, lines: int) -> DataFrame:
    """Ranks of prefixes of ``2 * lines`` lines from those of ``lines``, shared ones only."""
    ahead = Window.partitionBy(*_SEQ).orderBy("pos").rangeBetween(lines, lines)
    pairs = ranks.withColumn("next", F.max("rank").over(ahead)).filter("next is not null")
    place = F.struct(*_SEQ, "pos")
    shared = pairs.groupBy("rank", "next").agg(
        F.min(place).alias("least"), F.max(place).alias("most")).filter("least <> most")
    numbered = materialize(shared.select("rank", "next").orderBy("rank", "next").withColumn(
        "doubled", F.monotonically_increasing_id()), "pairs")
    return pairs.join(numbered, ["rank", "next"]).select(*_SEQ, "pos", F.col("doubled").alias("rank"))


def _later_copies(windows: DataFrame, ranks: DataFrame, lines: int) -> DataFrame:
    """Windows of ``lines`` to ``2 * lines - 1`` lines that equal an earlier one.

    The prefix at the start and the one that ends with the window cover it together.
    """
    mine = windows.filter(F.col("length").between(lines, 2 * lines - 1))
    tail = ranks.withColumnsRenamed({"pos": "tail", "rank": "second"})
    placed = mine.withColumn("tail", F.col("start") + F.col("length") - lines)
    keyed = _on_place(_on_place(placed, ranks.withColumnsRenamed({"pos": "start", "rank": "first"}), "start"),
                      tail, "tail")
    place = F.struct(*_SEQ, "start")
    keys = ["length", "first", "second"]
    origin = keyed.groupBy(*keys).agg(F.min(place).alias("least"), F.max(place).alias("most"))
    # Written, so that the join deals out a class with very many copies over several tasks.
    repeated = materialize(origin.filter("least <> most").select(*keys, "least"), "classes")
    return keyed.join(repeated, keys).filter(place != F.col("least")).select(*_SEQ, "start", "length")


def _on_place(left: DataFrame, right: DataFrame, pos: str) -> DataFrame:
    renamed = right.withColumnsRenamed({c: f"_{c}" for c in [*_SEQ, pos]})
    same = [F.col(pos) == F.col(f"_{pos}"), F.col("text_hash") == F.col("_text_hash"),
            F.col("doc_id").eqNullSafe(F.col("_doc_id"))]
    return left.join(renamed, same).drop(*[f"_{c}" for c in [*_SEQ, pos]])


def _merge(windows: DataFrame) -> DataFrame:
    """Overlapping or touching windows as maximal runs (seq, start, stop)."""
    by_start = Window.partitionBy(*_SEQ).orderBy("start", "stop")
    before = by_start.rowsBetween(Window.unboundedPreceding, -1)
    stops = windows.select(*_SEQ, "start", (F.col("start") + F.col("length")).alias("stop"))
    reach = F.max("stop").over(before)
    marked = stops.withColumn("reach", reach).withColumn(
        "opens", (F.col("reach").isNull() | (F.col("start") > F.col("reach"))).cast("int"))
    island = F.sum("opens").over(by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return marked.withColumn("island", island).groupBy(*_SEQ, "island").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop")).drop("island")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(late, doc_id, text_hash, start, stop): maximal runs of lines to delete.

    Lines count from 0, ``stop`` is exclusive.  The first copy, by (doc_id, text, line),
    stays; a null id comes last.  Rows equal in id and text are one document listed
    twice, not copies of each other.  Null texts have no lines.
    """
    lines = materialize(line_table(docs), "lines")
    ids = materialize(_repeated_ids(lines), "line-ids")
    ranked = lines.join(ids, "id", "left").select(*_SEQ, "pos", "rank", "words")
    windows = materialize(_windows(ranked, min_words), "line-windows")
    longest = windows.agg(F.max("length")).first()[0] or 0
    inside = lines.join(ids, "id").select(*_SEQ, "pos", "rank").distinct()
    found, size = [], 1
    ranks = materialize(inside, "ranks")
    while size <= longest:
        found.append(materialize(_later_copies(windows, ranks, size), "copies"))
        if 2 * size <= longest:
            ranks = materialize(_double(ranks, size), "ranks")
        size *= 2
    if not found:
        return windows.select(*_SEQ, "start", F.col("length").alias("stop")).limit(0)
    return _merge(reduce(DataFrame.unionByName, found))


def deduplicate_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies of repeated line runs cut out of ``text``.

    Adds ``lines_before``, ``lines_removed`` and ``words_removed``.  A null text stays
    null with 0 lines; a text whose every line goes becomes empty.
    """
    runs = repeated_runs(docs, min_words)
    gone = runs.groupBy(*_SEQ).agg(
        F.flatten(F.collect_list(F.sequence("start", F.col("stop") - 1))).alias("gone"))
    gone = gone.withColumnsRenamed({"doc_id": "gone_id", "text_hash": "gone_hash"}).drop("late")
    added = ["lines_before", "lines_removed", "words_removed"]
    kept_columns = [c for c in docs.columns if c not in added]
    # The array is built before the join, so the functions below do not split a text again.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept_columns if c != "text"]).alias("row"), F.col("doc_id").alias("id"),
        F.split("text", "\n").alias("lines"), F.xxhash64("text").alias("hash"))
    same = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("hash") == F.col("gone_hash"))
    joined = rows.join(gone.hint("shuffle_hash"), same, "left")
    count = F.coalesce(F.size("lines"), F.lit(0))
    none = F.array().cast("array<int>")
    dropped = F.coalesce("gone", none)
    places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(none)
    left = F.transform(F.array_except(places, dropped), lambda k: F.get("lines", k))
    cut = F.transform(dropped, lambda k: F.get("lines", k))
    text = F.when(F.col("gone").isNull(), F.array_join("lines", "\n")).otherwise(F.array_join(left, "\n"))
    found = joined.select(
        "row", text.alias("kept"), count.cast("long").alias("before"), F.size(dropped).cast("long").alias("removed"),
        F.regexp_count(F.array_join(cut, "\n"), F.lit(WORD)).cast("long").alias("cut_words"))
    columns = [(F.col("kept") if c == "text" else F.col("row").getField(c)).alias(c) for c in kept_columns]
    numbers = [F.col(c).alias(name) for c, name in zip(("before", "removed", "cut_words"), added)]
    return found.select(*columns, *numbers)


def cleaned_documents(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without repeated runs, its columns unchanged but ``text`` and ``n_chars``.

    Documents that lose all their words go; ``n_chars`` is counted anew where lines went.
    """
    found = deduplicate_lines(docs, min_words)
    empty = (F.col("lines_removed") > 0) & (F.regexp_count("text", F.lit(WORD)) == 0)
    length = F.when(F.col("lines_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return found.filter(~empty).select(*[
        length.cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


SQL = r"""with l as (
 select doc_id, string_split(text, chr(10)) as lines from documents where text is not null
), p as (
 select doc_id, unnest(range(0, len(lines) + 1)) as pos, lines from l
), c as (
 select doc_id, pos, lines, coalesce(sum(len(regexp_extract_all(coalesce(lines[pos + 1], ''), '[^\x20\x09-\x0D]+')))
  over (partition by doc_id order by pos rows between unbounded preceding and 1 preceding), 0)::bigint as c from p
), lo as (
 select doc_id, c, min(pos) as pos from c group by all
), hi as (
 select doc_id, c, max(pos) as pos from c group by all
), w as (
 select a.doc_id, a.pos as start, b.pos as stop, a.lines from c a asof join lo b
  on a.doc_id = b.doc_id and b.c >= a.c + 50
 union
 select a.doc_id, b.pos, a.pos, a.lines from c a asof join hi b on a.doc_id = b.doc_id and b.c <= a.c - 50
), k as (
 select doc_id, start, stop, md5(array_to_string(lines[start + 1:stop], chr(10))) as body from w
), f as (
 select *, min((doc_id, start)) over (partition by body) as origin from k
), g as (
 select doc_id, list_sort(list_distinct(flatten(list(range(start, stop))))) as gone from f
 where (doc_id, start) <> origin group by doc_id
), r as (
 select d.doc_id, d.text, coalesce(len(l.lines), 0) as n, l.lines, g.gone from documents d
 left join l on l.doc_id = d.doc_id left join g on g.doc_id = d.doc_id
)
select doc_id, case when gone is null then text else coalesce(array_to_string(list_transform(list_filter(
  range(0, n), lambda k: not list_contains(gone, k)), lambda k: lines[k + 1]), chr(10)), '') end as text,
 cast(n as bigint) as lines_before, cast(coalesce(len(gone), 0) as bigint) as lines_removed,
 cast(coalesce(len(regexp_extract_all(array_to_string(list_transform(gone, lambda k: lines[k + 1]), chr(10)),
  '[^\x20\x09-\x0D]+')), 0) as bigint) as words_removed from r"""
