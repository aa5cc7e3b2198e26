"""SimHash near-duplicates through popcounts of fingerprint segments.

A 64-bit fingerprint is embedded as the popcounts of its segments.  Flipping one bit
moves one popcount by one, so the Manhattan distance of two embeddings never exceeds
the Hamming distance of the fingerprints.  Every distinct fingerprint is registered in
all integer grid cells within half the radius of its embedding: two fingerprints within
the radius meet in a cell, and fingerprints without company in any cell are done.  In
shared cells the bound is checked exactly: a fingerprint registers the 64-bit values
within half the radius whose embedding is the cell, and fingerprints with a common value
are links.  Both steps emit a fixed number of rows a fingerprint, so neither a large
group of copies nor a crowded cell makes pairs; a group is stored as a star.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.components import connected
from marketlake.llm.text import NOT_SPACE, Chunk, map_chunks
from marketlake.session import materialize

SEED = 42
PRINTS_PER_TASK = 500_000


def shingle_hashes(chunk: Chunk, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(XXH64 of every shingle, edges by document) of lower-cased words joined by a space.

    A text with fewer words than ``shingle`` has one shingle, all its words.
    """
    starts, ends, words = chunk.spans(NOT_SPACE)
    lengths = ends - starts
    moved = np.cumsum(lengths + 1) - lengths - 1
    joined = np.full(int(lengths.sum()) + len(lengths), 32, np.uint8)
    inside = np.flatnonzero(NOT_SPACE[chunk.data])
    joined[inside + np.repeat(moved - starts, lengths)] = chunk.data[inside]
    blob = joined.tobytes()
    n_words = np.diff(words)
    count = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    edges = np.concatenate([[0], np.cumsum(count)])
    first = np.arange(edges[-1]) + np.repeat(words[:-1] - edges[:-1], count)
    last = first + np.repeat(np.minimum(np.maximum(n_words, 1), shingle) - 1, count)
    begin = moved[first].tolist()
    stop = (moved[last] + lengths[last]).tolist()
    digest = xxhash.xxh64_intdigest
    found = [digest(blob[a:b], SEED) for a, b in zip(begin, stop)]
    return np.array(found, dtype=np.uint64), edges


def _majority(hashes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Bits set in over half of each document's hashes; no hashes give zero."""
    out = np.zeros(len(edges) - 1, np.uint64)
    some = np.flatnonzero(np.diff(edges))
    if not len(some):
        return out
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    votes = np.add.reduceat(bits, edges[some], axis=0, dtype=np.int64)
    won = 2 * votes > np.diff(edges)[some][:, None]
    out[some] = np.packbits(won, axis=1, bitorder="little").reshape(-1, 8).copy().view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id",
                 text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, ``keep``, ``bits`` bigint): the fingerprint of every whole text, as a signed long."""
    def work(chunk: Chunk) -> dict[str, np.ndarray]:
        return {"bits": _majority(*shingle_hashes(chunk, shingle)).view(np.int64)}

    return map_chunks(docs, [id_col, *keep], text_col, work, "bits long", lower="ascii")


def _long(value: int) -> Column:
    return F.lit(value - (1 << 64) if value >= 1 << 63 else value).cast("long")


def popcounts(bits: Column, width: int) -> Column:
    """Popcount of every ``width``-bit segment, packed into a long in place of the segment.

    Neighbouring counts are added up in parallel: bits into 2-bit sums (by a half adder,
    which cannot overflow a long), those into 4-bit and 8-bit sums.
    """
    even = _long(0x5555555555555555)
    x, y = bits.bitwiseAND(even), F.shiftrightunsigned(bits, 1).bitwiseAND(even)
    sums = x.bitwiseXOR(y).bitwiseOR(F.shiftleft(x.bitwiseAND(y), 1))
    for step, low in ((2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F)):
        if step < width:
            part = _long(low)
            sums = sums.bitwiseAND(part) + F.shiftrightunsigned(sums, step).bitwiseAND(part)
    return sums


def _cells(prints: DataFrame, width: int, radius: int) -> DataFrame:
    """(cell, bits, segment, step): grid cells within ``radius`` (0 or 1) of the embedding."""
    field = _long((1 << width) - 1)
    own = F.struct(F.col("e").alias("cell"), F.lit(-1).alias("segment"), F.lit(0).alias("step"))
    cells = [own]
    for s in range(64 // width if radius else 0):
        count = F.shiftrightunsigned(F.col("e"), s * width).bitwiseAND(field)
        for step, possible in ((1, count < width), (-1, count > 0)):
            rest = F.col("e").bitwiseAND(_long(~((1 << width) - 1 << s * width) & (1 << 64) - 1))
            to = rest.bitwiseOR(F.shiftleft(count + step, s * width))
            cells.append(F.when(possible, F.struct(
                to.alias("cell"), F.lit(s).alias("segment"), F.lit(step).alias("step"))))
    spread = prints.select("bits", popcounts(F.col("bits"), width).alias("e")).select(
        "bits", F.explode(F.array(*cells)).alias("c"))
    return spread.filter("c is not null").select("bits", "c.*")


def _values(width: int) -> Column:
    """The fingerprint itself in its own cell, else it with one bit of the segment flipped."""
    flips = F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), F.col("segment") * width + k))
    set_bits = F.filter(flips, lambda one: (F.col("bits").bitwiseAND(one) != 0) == (F.col("step") < 0))
    return F.when(F.col("segment") < 0, F.array(F.col("bits"))).otherwise(
        F.transform(set_bits, lambda one: F.col("bits").bitwiseXOR(one)))


def links(prints: DataFrame, max_bits: int = 2, width: int = 4) -> DataFrame:
    """(a, b): a forest of stars joining distinct ``bits`` that differ in at most ``max_bits``.

    ``max_bits`` is 0, 1 or 2.  Every pair within the bound is joined through its common
    value, and every joined pair is within the bound; ``width`` (2, 4 or 8) is the segment
    length: shorter segments make finer cells.
    """
    if max_bits not in (0, 1, 2):
        raise ValueError("max_bits must be 0, 1 or 2")
    prints = materialize(prints.select("bits").filter("bits is not null").distinct(), "prints")
    # Each fingerprint becomes some thirty rows, so tasks are cut by fingerprints, not by bytes.
    tasks = max(prints.count() // PRINTS_PER_TASK + 1, prints.sparkSession.sparkContext.defaultParallelism)
    prints = prints.repartition(tasks)
    spread = _cells(prints, width, 1 if max_bits else 0)
    shared = spread.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("cell")
    met = spread.join(shared, "cell", "left_semi")
    values = met.select("bits", (F.col("segment") < 0).alias("own"), F.explode(_values(width)).alias("value"))
    # A value lies within one bit of at most 65 fingerprints, so these groups are small.
    stars = values.groupBy("value").agg(
        F.min("bits").alias("low"), F.max("own").alias("has_own"), F.collect_set("bits").alias("members"))
    if max_bits == 1:
        # Two fingerprints on either side of a value are two bits apart: only the value itself is a centre.
        stars = stars.filter("has_own").withColumn("low", F.col("value"))
    return stars.filter(F.size("members") > 1).select(
        F.explode("members").alias("a"), F.col("low").alias("b")).filter("a <> b")


def near_duplicates(prints: DataFrame, max_bits: int = 2, width: int = 4,
                    id_col: str = "doc_id") -> DataFrame:
    """(id, bits, root, component_id): the smallest fingerprint and id reachable over links.

    Rows with equal fingerprints form one class (a null or empty text has fingerprint
    zero and is linked like any other); classes are linked and their components found
    over distinct fingerprints only.  Null ids are not candidates for the smallest id; a
    component of null ids only has a null one.  Repeated rows stay repeated.
    """
    rows = materialize(prints.select(id_col, "bits"), "fingerprints")
    classes = rows.groupBy("bits").agg(F.min(id_col).alias("smallest"))
    roots = connected(links(classes, max_bits, width))
    labelled = classes.join(roots, classes["bits"] == roots["node"], "left").select(
        "bits", "smallest", F.coalesce("root", "bits").alias("root"))
    named = labelled.groupBy("root").agg(F.min("smallest").alias("component_id"))
    of_class = labelled.select("bits", "root").join(named, "root")
    return rows.join(of_class, "bits").select(id_col, "bits", "root", "component_id")


def to_hex(bits: Column) -> Column:
    return F.lpad(F.lower(F.hex(bits)), 16, "0")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """Rows of ``docs`` of which one stays for every group of near-duplicates.

    The row with the smallest id stays, a null id only where there is no other; of rows
    with the same id and group the one with the smallest text hash, and of rows equal in
    id and text any one.
    """
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    rows = materialize(fingerprints(hashed, shingle, keep=("text_hash",)), "fingerprints")
    # One row a distinct fingerprint.
    roots = materialize(near_duplicates(rows, max_bits).select("bits", "root").distinct(), "components")
    member = rows.join(roots, "bits").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash")).alias("first"))
    copies = rows.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    first = member.select(F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("first_hash"))
    kept = materialize(first.join(copies, F.col("first_id").eqNullSafe(F.col("doc_id"))
                                  & (F.col("first_hash") == F.col("text_hash"))).select(
        "first_id", "first_hash", "n").distinct(), "kept")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"),
                        F.xxhash64("text").alias("hash"))
    same = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("hash") == F.col("first_hash"))
    single = whole.join(kept.filter("n = 1"), same, "left_semi").select("row.*")
    repeated = whole.join(kept.filter("n > 1"), same, "left_semi").select("row.*").dropDuplicates(["doc_id", "text"])
    return single.unionByName(repeated)
