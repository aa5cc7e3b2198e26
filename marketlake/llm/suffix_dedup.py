"""Suffix-array dedup: bytes of every string of ``length`` bytes that also starts elsewhere go.

1. Every window of ``length`` bytes has the smallest hash of its byte grams as its anchor;
   equal windows have equal anchors.  Only windows whose anchor occurs twice somewhere can
   repeat; the others need no suffixes.
2. Documents with such windows are dealt to shards of bounded size by their smallest
   repeated anchor, so copies meet; an anchor with more text than a shard takes several.
3. A shard builds the suffix array of its candidate bytes by Larsson-Sadakane refinement
   and their common prefixes by Kasai's walk: intervals with ``length`` common bytes are
   equal windows, and repeat.
4. Windows whose anchor also lives in other shards leave the shard as sorted fingerprints,
   one for every interval, cut into ranges; the shards' arrays of a range are merged by
   binary search, and what two shards hold goes back to the windows it came from.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from marketlake.llm.suffixes import byte_grams, common_prefixes, covered, runs, sliding, suffix_array
from marketlake.llm.text import Chunk, mix, small_batches, text_chunks
from marketlake.session import materialize

LENGTH = 400
GRAM = 32
#: Text bytes of a shard, on average; a longer document is a shard of its own.
SHARD_BYTES = 2 << 20
#: Fingerprints merged by one task, at most on average.
MERGE_ROWS = 1 << 20
SPANS = "array<struct<start:long,end:long>>"


def _anchors(data: np.ndarray, edges: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash of every place, anchor of every window, whether the window lies in one document)."""
    if len(data) < length:
        none = np.zeros(0, np.uint64)
        return none, none, np.zeros(0, bool)
    grams = byte_grams(data, GRAM)
    anchor = sliding(grams, length - GRAM + 1, np.minimum)
    left = np.repeat(edges[1:], np.diff(edges)) - np.arange(len(data))
    return grams, anchor, left[: len(anchor)] >= length


def _anchor_places(grams: np.ndarray, anchor: np.ndarray, valid: np.ndarray, length: int) -> np.ndarray:
    """Places whose gram is the anchor of a window around it."""
    span = length - GRAM
    top = np.zeros(len(anchor) + 2 * span, np.uint64)
    top[span: span + len(anchor)][valid] = anchor[valid]
    return np.flatnonzero(sliding(top, span + 1, np.maximum) == grams)


def _outline(length: int):
    """Anchors of every document; one that it holds at several places is named twice."""
    def of(chunk: Chunk) -> pa.Array:
        grams, anchor, valid = _anchors(chunk.data, chunk.edges, length)
        at = _anchor_places(grams, anchor, valid, length) if valid.any() else np.zeros(0, np.int64)
        doc, gram = np.searchsorted(chunk.edges, at, "right") - 1, grams[at].view(np.int64)
        order = np.lexsort((gram, doc))
        doc, gram = doc[order], gram[order]
        third = np.zeros(len(doc), bool)
        third[2:] = (doc[2:] == doc[:-2]) & (gram[2:] == gram[:-2])
        doc, gram = doc[~third], gram[~third]
        cuts = np.searchsorted(doc, np.arange(chunk.n_docs + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(cuts), pa.array(gram))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch.column(4)):
                rows = batch.slice(chunk.first_row, chunk.n_docs)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(k) for k in range(4)), of(chunk)], ["id", "key", "n_bytes", "sha", "grams"])

    return run


def _finish(data: np.ndarray, edges: np.ndarray, gone: np.ndarray) -> tuple[list, list, pa.Array, list]:
    """(removed bytes, spans, span list, digest of what is left) of every document."""
    starts, ends = runs(gone, edges)
    first = np.searchsorted(starts, edges)
    counts = np.diff(first)
    removed = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=removed[1:])
    shas = []
    for k in range(len(edges) - 1):
        kept = data[edges[k]: edges[k + 1]]
        if counts[k]:
            kept = kept[~gone[edges[k]: edges[k + 1]]]
        shas.append(hashlib.sha256(kept).hexdigest())
    base = np.repeat(edges[:-1], counts)
    spans = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.StructArray.from_arrays(
        [pa.array(starts - base), pa.array(ends - base)], ["start", "end"]))
    return removed[first[1:]] - removed[first[:-1]], counts, spans, shas


def _whole(table: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one buffer, and where each begins."""
    texts = [t or b"" for t in table[column].cast(pa.large_binary()).to_pylist()]
    edges = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=edges[1:])
    return np.frombuffer(b"".join(texts), np.uint8), edges


def _known(values: np.ndarray, table: pa.Table, column: str) -> np.ndarray:
    """Which values stand in the table's lists."""
    lists = [c.flatten() for c in table[column].chunks]
    found = np.unique(np.concatenate([np.zeros(0, np.int64), *(x.to_numpy(zero_copy_only=False) for x in lists)]))
    found = np.sort(found.view(np.uint64))
    if not len(found):
        return np.zeros(len(values), bool)
    return found[np.minimum(np.searchsorted(found, values), len(found) - 1)] == values


def _repeats(data: np.ndarray, edges: np.ndarray, windows: np.ndarray,
             length: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, repeated) of the candidate windows: one window of each set of equal ones, and
    the windows that have an equal."""
    flags = covered(windows, length, len(data))
    place = np.flatnonzero(flags)
    starts, ends = runs(flags, edges)
    sizes = ends - starts
    stop = np.repeat(np.cumsum(sizes), sizes).astype(np.int32)
    piece = data[place]
    order = suffix_array(piece, stop, length)
    shared = common_prefixes(piece, stop, order, length)[order]
    # A break before every suffix that does not share a whole window with the one before.
    breaks = np.append(shared < length, True)
    alone = breaks[:-1] & breaks[1:]
    lead = np.zeros(len(piece), bool)
    lead[order[breaks[:-1]]] = True
    twice = np.zeros(len(piece), bool)
    twice[order[~alone]] = True
    at = np.searchsorted(place, windows)
    return windows[lead[at]], windows[twice[at]]


def _fingerprints(data: np.ndarray, grams: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit and a 32-bit hash of every window, from unlike functions."""
    chunk = Chunk(data, np.array([0, len(data)]), 0)
    second = np.zeros(len(at), np.uint64)
    for k in [*range(0, length - GRAM, GRAM), length - GRAM]:
        second = mix(second + grams[at + k])
    return chunk.hashes(at, at + length), (second >> np.uint64(32)).astype(np.uint32)


def _shard(length: int, buckets: int, kind: pa.DataType):
    def run(table: pa.Table) -> pa.Table:
        data, edges = _whole(table, "text")
        grams, anchor, valid = _anchors(data, edges, length)
        windows = np.flatnonzero(valid & _known(anchor, table, "grams"))
        first, twice = _repeats(data, edges, windows, length)
        gone = covered(twice, length, len(data))
        sent = first[_known(anchor[first], table, "crossing")]
        prints, second = _fingerprints(data, grams, sent, length)
        # A window that repeats in the shard needs no answer.
        asked = np.where(np.isin(sent, twice), -1, sent).astype(np.int32)
        pending = np.zeros(len(edges) - 1, bool)
        pending[np.searchsorted(edges, sent[asked >= 0], "right") - 1] = True
        removed, counts, spans, shas = _finish(data, edges, gone)
        n, size = len(edges) - 1, np.diff(edges)
        text = table["text"].combine_chunks()
        home, part = table["home"][0].as_py(), table["part"][0].as_py()
        docs = {
            "home": pa.array([home] * n, pa.int64()), "part": pa.array([part] * n, pa.int32()),
            "id": table["id"].combine_chunks(), "n_bytes": pa.array(size), "n_removed": pa.array(removed),
            "n_spans": pa.array(counts.astype(np.int64)), "spans": spans, "kept_sha256": pa.array(shas),
            "start": pa.array(edges[:-1]),
            "text": pa.array([t if p else None for t, p in zip(text.to_pylist(), pending.tolist())], pa.string()),
            "pending": pa.array(pending)}
        order = np.argsort(prints)
        prints, second, asked = prints[order], second[order], asked[order]
        bucket = (prints >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        names, cuts = np.unique(bucket, return_index=True)
        parts = [slice(a, b) for a, b in zip(cuts, np.append(cuts[1:], len(bucket)))]
        blobs = [[x[s].tobytes() for s in parts] for x in (prints, second, asked)]
        m = len(names)
        sets = {
            "home": pa.array([home] * m, pa.int64()), "part": pa.array([part] * m, pa.int32()),
            "bucket": pa.array(names.astype(np.int64)), "prints": pa.array(blobs[0], pa.binary()),
            "second": pa.array(blobs[1], pa.binary()), "asked": pa.array(blobs[2], pa.binary())}
        out = {}
        for f in _shard_schema(kind):
            a, b = docs.get(f.name), sets.get(f.name)
            a = pa.nulls(n, f.type) if a is None else a.cast(f.type)
            b = pa.nulls(m, f.type) if b is None else b.cast(f.type)
            out[f.name] = pa.chunked_array([a, b])
        return pa.table(out)

    return run


def _shard_schema(kind: pa.DataType) -> pa.Schema:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.schema([
        ("home", pa.int64()), ("part", pa.int32()), ("id", kind), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
        ("n_spans", pa.int64()), ("spans", span), ("kept_sha256", pa.string()), ("start", pa.int64()),
        ("text", pa.string()), ("pending", pa.bool_()), ("bucket", pa.int64()), ("prints", pa.binary()),
        ("second", pa.binary()), ("asked", pa.binary())])


def _both(a: tuple, b: tuple) -> tuple:
    """Two sorted sets of fingerprints as one; those in both are marked as common."""
    at = np.searchsorted(a[0], b[0])
    near = np.minimum(at, len(a[0]) - 1)
    same = (a[0][near] == b[0]) & (a[1][near] == b[1])
    common = a[2].copy()
    common[near[same]] = True
    new = ~same
    return tuple(np.insert(x, at[new], y[new]) for x, y in ((a[0], b[0]), (a[1], b[1]), (common, b[2])))


def _merge(table: pa.Table) -> pa.Table:
    """The sorted fingerprints of all shards in a range -> the asked windows that two shards hold."""
    sets = [tuple(np.frombuffer(table[c][k].as_py(), t) for c, t in (
        ("prints", np.uint64), ("second", np.uint32), ("asked", np.int32))) for k in range(len(table))]
    level = [(p, s, np.zeros(len(p), bool)) for p, s, _ in sets]
    while len(level) > 1:
        level = [_both(*level[k: k + 2]) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
    prints, second, common = level[0]
    hits = []
    for p, s, asked in sets:
        at = np.searchsorted(prints, p)
        hits.append(asked[common[at] & (second[at] == s) & (asked >= 0)].tolist())
    return pa.table({"home": table["home"], "part": table["part"], "hits": pa.array(hits, pa.list_(pa.int64()))})


def _answer(length: int, kind: pa.DataType):
    """Documents that asked, with the windows that other shards hold."""
    def run(docs: pa.Table, hits: pa.Table) -> pa.Table:
        docs = docs.take(np.argsort(docs["start"].to_numpy()))
        data, edges = _whole(docs, "text")
        shift = docs["start"].to_numpy() - edges[:-1]
        gone = np.zeros(len(data), bool)
        counts = docs["n_spans"].to_numpy()
        flat = pa.concat_arrays([c.flatten() for c in docs["spans"].chunks])
        a, b = (flat.field(k).to_numpy() + np.repeat(edges[:-1], counts) for k in (0, 1))
        gone |= covered(a, b - a, len(data))
        found = np.concatenate([np.zeros(0, np.int64), *(
            c.flatten().to_numpy(zero_copy_only=False) for c in hits["hits"].chunks)])
        doc = np.searchsorted(docs["start"].to_numpy(), found, "right") - 1
        gone |= covered(found - shift[doc], length, len(data))
        removed, n, spans, shas = _finish(data, edges, gone)
        return pa.table({
            "id": docs["id"].combine_chunks().cast(kind), "n_bytes": docs["n_bytes"], "n_removed": removed,
            "n_spans": n.astype(np.int64), "spans": spans, "kept_sha256": shas})

    return run


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now.

    It deletes them when the driver's JVM finds their jobs unreachable, which a small driver
    may not look for until the query is over.  What later steps read is written.
    """
    spark.sparkContext._jvm.System.gc()


def deduplicate(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, spans, kept_sha256), a row a row of ``docs``.

    Removed is every byte that a string of ``length`` bytes covers which also starts
    anywhere else, in any document or the same one; overlaps count, and no string crosses
    documents.  ``spans`` are the maximal removed runs as byte ranges from 0, ends
    exclusive; ``kept_sha256`` digests the bytes that stay.

    Null and empty texts, and texts shorter than ``length``, lose nothing.  Rows that are
    repeated, ids included, are documents of their own, so long ones go as a whole.  A very
    long text is a shard of its own and takes about 80 bytes of memory for each of its bytes
    that may repeat.  An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(docs[text_col], F.lit(""))
    plain = docs.select(docs[id_col].alias("id"), F.xxhash64(text).alias("key"),
                        F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha"),
                        text.alias("text"))
    kind = to_arrow_type(docs.schema[id_col].dataType)
    outline = materialize(plain.mapInArrow(
        _outline(length), f"id {id_type}, key long, n_bytes long, sha string, grams array<long>"), "outline")

    # Anchors that occur twice, and for every text its own ones of them.
    held = outline.select("key", F.explode("grams").alias("gram"))
    repeated = held.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    own = materialize(held.join(repeated, "gram").distinct(), "anchors")
    nearest = own.groupBy("key").agg(F.min("gram").alias("cluster"))
    sizes = materialize(outline.select("key", "n_bytes").join(nearest, "key").groupBy("key", "cluster").agg(
        F.sum("n_bytes").alias("bytes")), "clusters")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    clusters = sizes.groupBy("cluster").agg(F.sum("bytes").alias("bytes")).select(
        "cluster", F.ceil(F.col("bytes") * 2 / shard_bytes).cast("int").alias("parts"))
    heavy = F.col("parts") > 1
    placed = materialize(sizes.join(clusters, "cluster").select(
        "key", F.when(heavy, F.col("cluster")).otherwise(F.pmod("cluster", F.lit(shards))).alias("home"),
        F.when(heavy, F.ceil(F.col("parts") / 2)).otherwise(F.lit(0)).cast("int").alias("parts")), "placed")
    at = own.join(placed, "key")
    crossing = at.groupBy("gram").agg(F.min("home").alias("low"), F.max("home").alias("high"),
                                      F.max("parts").alias("parts")).filter("low < high or parts > 1")
    lists = materialize(own.join(crossing.select("gram", F.lit(True).alias("crosses")), "gram", "left").groupBy(
        "key").agg(F.collect_list("gram").alias("grams"),
                   F.collect_list(F.when(F.col("crosses"), F.col("gram"))).alias("crossing")), "lists")
    windows = (lists.agg(F.sum(F.size("crossing"))).first()[0] or 0) * (length - GRAM + 1)
    buckets = max(1, -(-windows // MERGE_ROWS))

    long_texts = plain.filter(F.col("n_bytes") >= length).select(
        "id", "key", "text", F.rand(11).alias("spread"))
    dealt = long_texts.join(lists.join(placed, "key"), "key").select(
        "home", F.when(F.col("parts") > 0, F.floor(F.col("spread") * F.col("parts"))).otherwise(-1).cast("int")
        .alias("part"), "id", "text", "grams", "crossing")
    schema = (f"home long, part int, id {id_type}, n_bytes long, n_removed long, n_spans long, spans {SPANS}, "
              "kept_sha256 string, start long, text string, pending boolean, bucket long, prints binary, "
              "second binary, asked binary")
    found = materialize(dealt.groupBy("home", "part").applyInArrow(_shard(length, buckets, kind), schema), "shards")
    drop_shuffles(spark)

    hits = found.filter("bucket is not null").select("home", "part", "bucket", "prints", "second", "asked").groupBy(
        "bucket").applyInArrow(_merge, "home long, part int, hits array<long>")
    out = ["id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"]
    asked = found.filter("pending").select("home", "part", "start", "text", *out)
    answered = asked.groupBy("home", "part").cogroup(
        hits.filter(F.size("hits") > 0).groupBy("home", "part")).applyInArrow(
        _answer(length, kind), f"id {id_type}, n_bytes long, n_removed long, n_spans long, spans {SPANS}, kept_sha256 string")
    untouched = outline.join(lists.select("key"), "key", "left_anti").select(
        "id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.array().cast(SPANS).alias("spans"), F.col("sha").alias("kept_sha256"))
    whole = untouched.unionByName(found.filter("not pending").select(*out)).unionByName(answered)
    return whole.withColumnRenamed("id", id_col)


#: Every window of 400 bytes by its MD5, their runs, and the bytes between the runs.
SQL = """
with d as (select row_number() over () as doc, doc_id, encode(coalesce(text, '')) as x,
  strlen(coalesce(text, ''))::bigint as n from documents),
w as (select doc, p, md5(x[p + 1 : p + 400]) as h
 from (select doc, x, unnest(range(greatest(n - 399, 0))) as p from d)),
twice as (select doc, p from w qualify count(*) over (partition by h) > 1),
steps as (select doc, p, case when p <= lag(p) over (partition by doc order by p) + 400 then 0 else 1 end as new
 from twice),
numbered as (select doc, p, sum(new) over (partition by doc order by p) as run from steps),
spans as (select doc, run, min(p) as a, max(p) + 400 as b from numbered group by doc, run),
cuts as (select doc, a, b from spans union all select doc, n, n from d),
kept as (select c.doc, string_agg(hex(d.x[c.last + 1 : c.a]), '' order by c.a, c.last) as bytes
 from (select doc, a, coalesce(lag(b) over (partition by doc order by a, b), 0) as last from cuts) c join d using (doc)
 group by c.doc),
sums as (select doc, sum(b - a) as gone, count(*) as n_spans from spans group by doc)
select d.doc_id, d.n as n_bytes, coalesce(s.gone, 0)::bigint as n_removed, coalesce(s.n_spans, 0)::bigint as n_spans,
 sha256(unhex(k.bytes)) as kept_sha256
from d join kept k using (doc) left join sums s using (doc)
"""
