"""Source divergence audit: how the words of a language's sources differ, pair by pair.

Terms are counted by (language, source) in the scan.  The terms that enough documents of a
language hold are numbered, and every group's counts become sorted arrays of (term id,
count), cut into cells of ``CELL`` ids, so no task holds a vocabulary.  A task co-groups
the cells of one unordered pair of sources: a galloping search of the shorter array in the
longer one finds the shared terms, and the price of shared terms, of terms that only one
source has and of terms that neither has add up to the divergence, which is the same
both ways.

All arithmetic is on integers.  It is exact while a language's occurrences and twice its
terms sum up to less than 9 * 10^15.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.numbering import numbered
from marketlake.llm.text import byte_class, doc_of, small_batches, text_chunks
from marketlake.session import materialize

#: ASCII letters and every byte of a non-ASCII character.
LETTER = byte_class(lambda b: chr(b).isalpha() if b < 128 else True)
LEAST_DOCS = 10
TOP_TERMS = 10
UNIT = 1_000_000_000
CELL_BITS = 16
#: Rows of counts that a task gathers before it hands them on.
HELD_ROWS = 300_000
COUNTS = "lang string, source string, term string, n long, docs long"


def _chunk_counts(chunk, langs: pa.Array, sources: pa.Array) -> pa.Table:
    starts, ends, edges = chunk.spans(LETTER)
    sizes = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=sizes[1:])
    words = pa.Array.from_buffers(pa.string(), len(starts), [
        None, pa.py_buffer(sizes), pa.py_buffer(chunk.data[LETTER[chunk.data]])]).dictionary_encode()
    code, terms = words.indices.to_numpy(), words.dictionary
    lang, source = langs.dictionary_encode(), sources.dictionary_encode()
    group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
    doc = doc_of(edges)
    wide = max(len(terms), 1)
    keys, n = np.unique(group[doc] * wide + code, return_counts=True)
    held = np.unique(doc * wide + code)
    _, docs = np.unique(group[held // wide] * wide + held % wide, return_counts=True)
    of = keys // wide
    return pa.table({
        "lang": lang.dictionary.take(pa.array(of // len(source.dictionary))),
        "source": source.dictionary.take(pa.array(of % len(source.dictionary))),
        "term": terms.take(pa.array(keys % wide)), "n": n, "docs": docs})


def _added(parts: list[pa.Table]) -> pa.Table:
    whole = pa.concat_tables(parts).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return whole.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(["lang", "source", "term", "n", "docs"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, rows = [], 0
    for batch in batches:
        for chunk in text_chunks(batch.column(2), lower="ascii"):
            here = batch.slice(chunk.first_row, chunk.n_docs)
            parts.append(_chunk_counts(chunk, here.column(0), here.column(1)))
            rows += len(parts[-1])
            if rows > HELD_ROWS:
                parts = [_added(parts)]
                rows = len(parts[0])
                if rows > HELD_ROWS // 2:
                    yield from parts[0].to_batches()
                    parts, rows = [], 0
    if parts:
        yield from _added(parts).to_batches()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term, by group.

    Null language, source and text count as ''.
    """
    small_batches(docs.sparkSession)
    plain = docs.select(*[F.coalesce(docs[c], F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return plain.mapInArrow(_count, COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _rate(n: str, total: str, terms: str) -> Column:
    """Smoothed share in billionths, rounded down, plus 1."""
    return F.expr(f"1 + (cast({n} + 2 as decimal(19,0)) * {UNIT}bd) div cast({total} + 2 * {terms} as decimal(19,0))")


def _rates(n: np.ndarray, whole: int) -> np.ndarray:
    """The same for arrays: the long division is done a thousand at a time, so it stays within 64 bits."""
    left = n.astype(np.int64) + 2
    out = left // whole * UNIT + 1
    left = left % whole
    for unit in (UNIT // 1000, UNIT // 1_000_000, 1):
        left = left * 1000
        out += left // whole * unit
        left = left % whole
    return out


def _price(p: np.ndarray, q: np.ndarray) -> int:
    return int(((p - q) * (p - q) // (p + q)).sum())


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray, int, int]:
    # A missing cell is a null list, which is empty when flattened.
    flat = table["cell"].chunk(0).flatten()
    ids, n = (flat.field(k).to_numpy() for k in (0, 1))
    return ids, n, table["whole"][0].as_py(), table["wide"][0].as_py()


def _pair(first: pa.Table, second: pa.Table) -> pa.Table:
    a_ids, a_n, a_whole, wide = _sides(first)
    b_ids, b_n, b_whole, _ = _sides(second)
    swap = len(a_ids) > len(b_ids)
    short, long_ = (b_ids, a_ids) if swap else (a_ids, b_ids)
    at = np.searchsorted(long_, short)
    same = np.zeros(len(short), bool)
    inside = at < len(long_)
    same[inside] = long_[at[inside]] == short[inside]
    in_short, in_long = np.flatnonzero(same), at[same]
    in_a, in_b = (in_long, in_short) if swap else (in_short, in_long)
    p, q = _rates(a_n, a_whole), _rates(b_n, b_whole)
    none_p, none_q = (_rates(np.zeros(1, np.int64), w) for w in (a_whole, b_whole))
    only_a, only_b = np.delete(p, in_a), np.delete(q, in_b)
    absent = wide - len(in_a) - len(only_a) - len(only_b)
    return pa.table({
        **{k: first[k] for k in ("lang", "first", "second")},
        "shared": [_price(p[in_a], q[in_b])], "only_first": [_price(only_a, none_q)],
        "only_second": [_price(none_p, only_b)], "absent": [absent * _price(none_p, none_q)]})


def _numbered_terms(counts: DataFrame, least_docs: int) -> DataFrame:
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = materialize(kept.filter(F.col("docs") >= least_docs).select("lang", "term", "lang_n"), "audit-terms")
    return materialize(numbered(kept, "lang", ["term"]), "audit-terms")


def pair_prices(groups: DataFrame, counted: DataFrame) -> DataFrame:
    """(lang, first, second, shared, only_first, only_second, absent): a row an unordered pair of sources.

    ``groups`` (lang, source, n, v) and ``counted`` (lang, source, pos, n) are written tables.
    """
    cells = counted.groupBy("lang", "source", F.shiftright("pos", CELL_BITS).alias("block")).agg(F.array_sort(
        F.collect_list(F.struct(F.col("pos").bitwiseAND(F.lit((1 << CELL_BITS) - 1)).alias("id"), "n"))).alias("cell"))
    blocks = F.explode(F.expr(f"sequence(0L, shiftright(v - 1, {CELL_BITS}))"))
    frame = groups.filter("v > 0").select("lang", "source", (F.col("n") + 2 * F.col("v")).alias("whole"), "v",
                                          blocks.alias("block"))
    cells = materialize(frame.join(cells, ["lang", "source", "block"], "left").select(
        "lang", "source", "block", "whole",
        F.least(F.lit(1 << CELL_BITS), F.col("v") - F.shiftleft("block", CELL_BITS)).alias("wide"), "cell"),
        "audit-cells")
    one = groups.select("lang", F.col("source").alias("first"))
    pairs = materialize(one.join(groups.select("lang", F.col("source").alias("second")), "lang").filter(
        "first < second"), "audit-pairs")
    task = ["lang", "first", "second", "block"]
    columns = ["whole", "wide", "cell"]
    # New column ids for each side, as both come from one table.
    sides = [cells.withColumnRenamed("source", side).join(pairs, ["lang", side]).select(
        *[F.col(c).alias(c) for c in [*task, *columns]]).groupBy(*task) for side in ("first", "second")]
    parts = ["shared", "only_first", "only_second", "absent"]
    schema = "lang string, first string, second string, " + ", ".join(f"{c} long" for c in parts)
    priced = sides[0].cogroup(sides[1]).applyInArrow(_pair, schema).groupBy("lang", "first", "second").agg(
        *[F.sum(c).alias(c) for c in parts])
    return pairs.join(priced, ["lang", "first", "second"], "left").select(
        "lang", "first", "second", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in parts])


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): divergent pairs of sources, and each source's own terms.

    Part ``pair``: every other source of the language, by the summed divergence over all kept
    terms.  Part ``term``: the ``top_terms`` terms that the source has more of than its
    language.  Kept are the terms in at least ``least_docs`` documents of the language.

    Null language, source and text are ''; empty texts have no terms, yet their group
    counts.  Repeated rows are documents of their own; ties in value are ranked by item.  A
    very long text costs a task its size a few times over.  An empty table gives no rows;
    other columns are not read.
    """
    counts = materialize(term_counts(docs), "audit-counts")
    terms = _numbered_terms(counts, least_docs)
    counted = materialize(
        counts.select("lang", "source", "term", "n").join(terms, ["lang", "term"]), "audit-counted")
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    names = docs.select(*[F.coalesce(docs[c], F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    sums = counted.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = names.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = materialize(groups.select(
        "lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n", "v", "lang_total")]),
        "audit-groups")

    prices = pair_prices(groups, counted)
    value = F.col("shared") + F.col("only_first") + F.col("only_second") + F.col("absent")
    both = prices.select("lang", value.alias("value"), F.explode(F.array(
        F.struct(F.col("first").alias("source"), F.col("second").alias("item")),
        F.struct(F.col("second").alias("source"), F.col("first").alias("item")))).alias("way"))
    both = both.select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value")

    own = counted.join(groups.select("lang", "source", F.col("n").alias("total"), "v", "lang_total"), ["lang", "source"])
    own = own.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                     _rate("n", "total", "v").alias("p"), _rate("lang_n", "lang_total", "v").alias("q"))
    own = own.filter("p > q").select("lang", "source", "part", "item",
                                     F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    best = own.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_terms)
    return both.withColumn("rank", F.row_number().over(order)).unionByName(best)


SQL = r"""
with d as (select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
w as (select doc, lang, source, unnest(terms) as term from d),
kept as (select lang, term, count(*) as n from w group by lang, term having count(distinct doc) >= 10),
c as (select w.lang, w.source, w.term, count(*) as n from w join kept using (lang, term) group by all),
g as (select lang, source, coalesce((select sum(n) from c where c.lang = x.lang and c.source = x.source), 0)::hugeint as n,
  (select count(*) from kept where kept.lang = x.lang)::hugeint as v,
  coalesce((select sum(n) from kept where kept.lang = x.lang), 0)::hugeint as lang_n
 from (select distinct lang, source from d) x),
r as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
  1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (g.n + 2 * g.v) as p,
  1 + (1000000000::hugeint * (k.n + 2)) // (g.lang_n + 2 * g.v) as q
 from g join kept k using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
pair as (select a.lang, a.source, b.source as item,
  coalesce((select sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) from r x join r y
    on x.lang = a.lang and x.source = a.source and y.lang = a.lang and y.source = b.source and x.term = y.term), 0) as value
 from g a join g b on a.lang = b.lang and a.source <> b.source),
term as (select lang, source, term as item, ((p - q) * (p - q)) // (p + q) as value from r where n > 0 and p > q),
both_ as (select lang, source, 'pair' as part, item, value from pair
 union all select lang, source, 'term', item, value from term),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from both_)
select lang, source, part, item, value::bigint as value, rank::int as rank from ranked where part = 'pair' or rank <= 10
"""
