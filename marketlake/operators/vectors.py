"""Nearest vectors by cosine: exact in blocks, and by random hyperplanes with multi-probe.

Vectors are arrays of numbers, keys are integers.  Rows whose vector is null, zero or of
another length than most take no part.  A similarity is rounded to ``DIGITS`` decimals; equal
ones are ranked by the smaller key, so results do not depend on how rows are dealt out.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIGITS = 10
#: Queries that one pass over all rows holds in memory.
BLOCK_QUERIES = 4096
#: Rows of vectors that are multiplied at a time.
STEP_ROWS = 2048
#: Rows, or queries, of a bucket beyond which it is split between tasks.
BUCKET_ROWS = 20_000
#: Rows aimed at per bucket, from which the number of hyperplanes follows.
ROWS_PER_CODE = 256
TABLES = 3
MOST_BITS, MOST_PROBES = 24, 4096
FOUND = "query long, neighbour long, similarity double"


def _plain(rows: DataFrame, key: str, vector: str, dim: int) -> DataFrame:
    values = rows[vector].cast("array<float>")
    fits = (F.size(values) == dim) & F.exists(values, lambda x: x != 0) & ~F.exists(
        values, lambda x: x.isNull() | F.isnan(x))
    return rows.select(rows[key].cast("long").alias("key"), values.alias("vector")).filter(
        fits & F.col("key").isNotNull())


def dimension(rows: DataFrame, vector: str) -> int:
    """The most frequent length of the vectors, the larger of equals; 0 without any."""
    size = rows.select(F.size(vector).alias("size")).filter("size > 0").groupBy("size").count()
    found = size.orderBy(F.desc("count"), F.desc("size")).first()
    return found["size"] if found else 0


def _units(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Unit vectors, one a row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return flat / np.linalg.norm(flat, axis=1)[:, None]


def _best(query: np.ndarray, key: np.ndarray, similarity: np.ndarray, k: int) -> tuple:
    """The k best of every query: most similar first, then the smaller key."""
    order = np.lexsort((key, -similarity, query))
    query, key, similarity = query[order], key[order], similarity[order]
    first = np.searchsorted(query, query, "left")
    keep = np.arange(len(query)) - first < k
    return query[keep], key[keep], similarity[keep]


def _nearest(q_keys: np.ndarray, q_units: np.ndarray, keys: np.ndarray, units: np.ndarray, k: int) -> tuple:
    """(query, key, similarity) of the k most similar rows to every query, itself left out."""
    best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    for at in range(0, len(keys), STEP_ROWS):
        part = keys[at: at + STEP_ROWS]
        scores = np.round(q_units @ units[at: at + STEP_ROWS].T, DIGITS)
        scores[q_keys[:, None] == part[None, :]] = -2
        if len(part) > k:
            edge = np.partition(scores, len(part) - k, axis=1)[:, len(part) - k]
        else:
            edge = np.full(len(q_keys), -1.5)
        row, column = np.nonzero((scores >= edge[:, None]) & (scores > -1.5))
        new = (q_keys[row], part[column], scores[row, column])
        best = _best(*(np.concatenate(x) for x in zip(best, new)), k)
    return best


def _first(found: DataFrame, k: int) -> DataFrame:
    """(query, rank, neighbour, similarity): the k best of every query."""
    order = Window.partitionBy("query").orderBy(F.desc("similarity"), "neighbour")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query", "rank", "neighbour", "similarity")


def exact_neighbours(rows: DataFrame, queries: DataFrame, key: str, vector: str, k: int = 10,
                     block: int = BLOCK_QUERIES) -> DataFrame:
    """(query, rank, neighbour, similarity): the k rows of ``rows`` most similar to every query.

    A block of queries goes to all tasks and is held against all rows, so rows are never
    shuffled; a task hands on k rows a query.
    """
    dim = dimension(rows, vector)
    everything = _plain(rows, key, vector, dim)
    asked = _plain(queries, key, vector, dim)
    blocks = max(1, -(-asked.count() // block))

    def task(q_keys: np.ndarray, q_units: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
            for batch in batches:
                new = _nearest(q_keys, q_units, batch.column(0).to_numpy(), _units(batch.column(1), dim), k)
                best = _best(*(np.concatenate(x) for x in zip(best, new)), k)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in best], ["query", "neighbour", "similarity"])

        return run

    found = None
    for b in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b).toArrow()
        if len(part):
            here = everything.mapInArrow(task(part["key"].to_numpy(), _units(part["vector"], dim)), FOUND)
            found = here if found is None else found.unionByName(here)
    if found is None:
        found = rows.sparkSession.createDataFrame([], FOUND)
    return _first(found, k)


@dataclass(frozen=True)
class Index:
    """Hyperplanes of every table, and which sides of them a query looks at besides its own.

    ``probes`` has a row a probe: the hyperplanes, by rank of their distance to the query,
    on whose other side the probe lies.
    """

    planes: np.ndarray
    probes: np.ndarray

    @property
    def bits(self) -> int:
        return self.planes.shape[2]

    def codes(self, units: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(table, code, distances) of all vectors."""
        weight = 1 << np.arange(self.bits, dtype=np.int64)
        for table, normals in enumerate(self.planes):
            side = units @ normals
            yield table, (side > 0) @ weight, np.abs(side)

    def looked_at(self, code: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """Codes that every query probes, nearest first."""
        by_rank = (1 << np.argsort(distance, axis=1, kind="stable")).astype(np.int64)
        return code[:, None] ^ (by_rank @ self.probes.T.astype(np.int64))


def probe_order(bits: int, most: int) -> np.ndarray:
    """Sets of hyperplanes to cross, least expected squared distance first; (probes, bits) flags."""
    normal = NormalDist()
    cost = [normal.inv_cdf((1 + (j + 0.5) / bits) / 2) ** 2 for j in range(bits)]
    sets: list[tuple[int, ...]] = [()]
    heap = [(cost[0], (0,))]
    while heap and len(sets) < most:
        total, chosen = heapq.heappop(heap)
        sets.append(chosen)
        last = chosen[-1]
        if last + 1 < bits:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*chosen, last + 1)))
    out = np.zeros((len(sets), bits), bool)
    for k, chosen in enumerate(sets):
        out[k, list(chosen)] = True
    return out


def _planes(dim: int, bits: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((tables, dim, bits))


def fit_index(rows: DataFrame, queries: DataFrame, key: str, vector: str, k: int = 10, target: float = 0.95,
              tables: int = TABLES, sample: int = 64, seed: int = 7) -> Index:
    """Choose hyperplanes and probes so that ``target`` of the true neighbours of a sample are found.

    The sample is ``sample`` queries, first by a hash of their keys; their exact neighbours are
    found by one pass.  The number of hyperplanes starts from ``ROWS_PER_CODE`` and falls until
    ``MOST_PROBES`` suffice; with few of them all codes can be probed, so it always ends.
    """
    dim = dimension(rows, vector)
    plain = _plain(rows, key, vector, dim)
    total = plain.count()
    bits = int(np.clip(np.log2(max(total, 1) / ROWS_PER_CODE), 3, MOST_BITS))
    some = _plain(queries, key, vector, dim).orderBy(F.xxhash64("key"), "key").limit(sample)
    truth = exact_neighbours(plain, some, "key", "vector", k).select("query", "neighbour")
    near = truth.join(plain.withColumnsRenamed({"key": "neighbour", "vector": "near"}), "neighbour").join(
        some.withColumnsRenamed({"key": "query"}), "query").select("vector", "near").toArrow()
    while True:
        index = Index(_planes(dim, bits, tables, seed), probe_order(bits, MOST_PROBES))
        if not len(near):
            return Index(index.planes, index.probes[:1])
        rank = np.full(len(near), len(index.probes))
        asked, wanted = _units(near["vector"], dim), _units(near["near"], dim)
        for (_, code, distance), (_, goal, _) in zip(index.codes(asked), index.codes(wanted)):
            hit = index.looked_at(code, distance) == goal[:, None]
            rank = np.minimum(rank, np.where(hit.any(axis=1), hit.argmax(axis=1), len(index.probes)))
        needed = int(np.sort(rank)[int(np.ceil(target * len(rank))) - 1]) + 1
        if needed <= len(index.probes):
            return Index(index.planes, index.probes[:needed])
        bits -= 2


def _slots(index: Index, dim: int, probing: bool):
    """(slot, key, vector): the bucket of a vector in every table, or all that a query probes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _units(batch.column(1), dim)
            for table, code, distance in index.codes(units):
                at, slot = np.arange(len(code)), code
                if probing:
                    slot = index.looked_at(code, distance)
                    at, slot = np.repeat(at, slot.shape[1]), slot.ravel()
                for a in range(0, len(at), STEP_ROWS):
                    rows = batch.take(pa.array(at[a: a + STEP_ROWS]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((table << MOST_BITS) + slot[a: a + STEP_ROWS]), rows.column(0), rows.column(1)],
                        ["slot", "key", "vector"])

    return run


def _bucket(dim: int, k: int):
    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        if len(asked) and len(held):
            keys, units = held["key"].to_numpy(), _units(held["vector"], dim)
            q_keys, q_units = asked["key"].to_numpy(), _units(asked["vector"], dim)
            parts = [_nearest(q_keys[a: a + STEP_ROWS], q_units[a: a + STEP_ROWS], keys, units, k)
                     for a in range(0, len(q_keys), STEP_ROWS)]
            best = tuple(np.concatenate(x) for x in zip(*parts))
        return pa.table(dict(zip(("query", "neighbour", "similarity"), best)))

    return run


def neighbours(rows: DataFrame, queries: DataFrame, index: Index, key: str, vector: str, k: int = 10,
               bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(query, rank, neighbour, similarity) as in ``exact_neighbours``, among the rows that ``index`` proposes.

    Every row goes to one bucket a table, a query to all buckets that it probes; a bucket's
    task compares its rows with its queries and hands on k rows a query, never the pairs.
    A bucket with more than ``bucket_rows`` rows, or queries, is split into a grid of tasks
    which together compare everything.
    """
    dim = index.planes.shape[1]
    schema = "slot long, key long, vector array<float>"
    held = _plain(rows, key, vector, dim).mapInArrow(_slots(index, dim, False), schema)
    asked = _plain(queries, key, vector, dim).mapInArrow(_slots(index, dim, True), schema)
    counts = held.groupBy("slot").agg(F.count(F.lit(1)).alias("rows")).join(
        asked.groupBy("slot").agg(F.count(F.lit(1)).alias("asked")), "slot")
    grid = counts.select("slot", F.ceil(F.col("rows") / bucket_rows).cast("int").alias("row_parts"),
                         F.ceil(F.col("asked") / bucket_rows).cast("int").alias("query_parts"))

    def dealt(side: DataFrame, own: str, other: str, own_part: str, other_part: str) -> DataFrame:
        return side.join(grid, "slot").select(
            "slot", F.pmod(F.xxhash64("key"), F.col(own)).cast("int").alias(own_part),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other_part), "key", "vector")

    task = ["slot", "row_part", "query_part"]
    left = dealt(asked, "query_parts", "row_parts", "query_part", "row_part").select(*task, "key", "vector")
    right = dealt(held, "row_parts", "query_parts", "row_part", "query_part").select(
        *[F.col(c).alias(c) for c in [*task, "key", "vector"]])
    found = left.groupBy(*task).cogroup(right.groupBy(*task)).applyInArrow(_bucket(dim, k), FOUND)
    return _first(found.dropDuplicates(["query", "neighbour"]), k)


def recall(found: DataFrame, truth: DataFrame) -> DataFrame:
    """(query_cnt, pair_cnt, found_cnt, recall): how many of the true neighbours were found."""
    same = found.select("query", "neighbour", F.lit(1).alias("hit"))
    return truth.join(same, ["query", "neighbour"], "left").agg(
        F.count_distinct("query").alias("query_cnt"), F.count(F.lit(1)).alias("pair_cnt"),
        F.count("hit").alias("found_cnt"), (F.count("hit") / F.count(F.lit(1))).alias("recall"))
