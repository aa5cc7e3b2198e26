"""Words, lines and n-grams of Arrow text batches as numpy arrays.

The Python operators of this folder run inside ``mapInArrow`` tasks.  Each batch is cut
into chunks of whole documents of about ``CHUNK_BYTES``, so memory is bounded by one
chunk or by the longest single document, and every step works on all bytes or words of
a chunk at once.  Bytes are UTF-8; the word classes in use never split a character.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CHUNK_BYTES = 500_000
#: Rows that Spark hands to a Python worker at a time; texts are long, so fewer than by default.
BATCH_ROWS = 1000
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTERS = np.random.default_rng(2024).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def byte_class(keep: Callable[[int], bool]) -> np.ndarray:
    return np.array([keep(b) for b in range(256)])


#: Everything but space and \t \n \v \f \r.
NOT_SPACE = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Digits, ASCII letters and every byte of a non-ASCII character.
ALNUM = byte_class(lambda b: chr(b).isalnum() if b < 128 else True)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) <= n:
        size = 1 << (n + 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def per_doc(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between consecutive ``edges``."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[edges[1:]] - total[edges[:-1]]


class Chunk:
    """Some whole documents: ``data`` holds their bytes, ``edges`` where each begins."""

    def __init__(self, data: np.ndarray, edges: np.ndarray, first_row: int):
        self.data, self.edges, self.first_row = data, edges, first_row
        self.n_docs = len(edges) - 1
        self._sums = None

    def spans(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, edges) of maximal runs of ``member`` bytes, cut at documents."""
        inside = member[self.data]
        before = np.zeros(len(inside), bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(inside), bool)
        after[:-1] = inside[1:]
        cuts = self.edges[1:-1]
        before[cuts[cuts < len(inside)]] = False
        after[cuts[cuts > 0] - 1] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        return starts, ends, np.searchsorted(starts, self.edges)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        r"""(start, end, edges) of the lines between \n of every document."""
        at = np.flatnonzero(self.data == 10)
        inner = np.searchsorted(at, self.edges)
        counts = np.diff(inner) + 1
        edges = np.concatenate([[0], np.cumsum(counts)])
        starts = np.empty(edges[-1], np.int64)
        ends = np.empty(edges[-1], np.int64)
        heads = np.zeros(edges[-1], bool)
        heads[edges[:-1]] = True
        starts[heads] = self.edges[:-1]
        starts[~heads] = at + 1
        tails = np.zeros(edges[-1], bool)
        tails[edges[1:] - 1] = True
        ends[tails] = self.edges[1:]
        ends[~tails] = at
        return starts, ends, edges

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of every byte range; equal bytes give equal hashes anywhere."""
        power, inverse = _power_tables(len(self.data) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_LETTERS[self.data] * power[: len(self.data)], out=self._sums[1:])
        whole = (self._sums[ends] - self._sums[starts]) * inverse[starts]
        return mix(whole + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def doc_of(edges: np.ndarray) -> np.ndarray:
    """The document of every item, from the items' edges."""
    return np.repeat(np.arange(len(edges) - 1), np.diff(edges))


def ngrams(word_hash: np.ndarray, edges: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of every run of n words inside a document."""
    count = np.maximum(np.diff(edges) - n + 1, 0)
    total = int(count.sum())
    skip = np.cumsum(count) - count
    first = np.arange(total) - np.repeat(skip, count) + np.repeat(edges[:-1], count)
    out = np.zeros(total, np.uint64)
    for k in range(n):
        out = mix(out + word_hash[first + k] * np.uint64(0x9FB21C651E98DF25) + np.uint64(k + 1))
    return out, first


def repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs more than once."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    out = np.empty(len(keys), bool)
    out[order] = same[:-1] | same[1:]
    return out


def text_chunks(column: pa.Array, lower: str = "") -> Iterator[Chunk]:
    """Chunks of a text column; a null text is an empty one.

    ``lower`` is "" (as it is), "ascii" (A-Z only) or "unicode" (every capital letter).
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if lower == "unicode":
        column = pc.utf8_lower(column.cast(pa.large_string()))
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return
    _, offsets, values = column.buffers()
    edges = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        stop = int(np.searchsorted(edges, edges[at] + CHUNK_BYTES, "right")) - 1
        stop = min(max(stop, at + 1), len(column))
        piece = data[edges[at]: edges[stop]]
        yield Chunk(LOWER[piece] if lower == "ascii" else piece, edges[at: stop + 1] - edges[at], at)
        at = stop


def small_batches(spark: SparkSession) -> None:
    """Bound what an Arrow batch of texts takes, in the JVM and in the worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def map_chunks(df: DataFrame, keep: list[str], text: str,
               work: Callable[[Chunk], dict[str, np.ndarray]], schema: str,
               lower: str = "") -> DataFrame:
    """One output row a document: its ``keep`` columns and what ``work`` finds in its text.

    ``schema`` declares the columns of ``work``, whose arrays hold a value a document.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch.column(len(keep)), lower):
                rows = batch.slice(chunk.first_row, chunk.n_docs)
                found = work(chunk)
                columns = [rows.column(k) for k in range(len(keep))]
                columns += [v if isinstance(v, pa.Array) else pa.array(v) for v in found.values()]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *found])

    small_batches(df.sparkSession)
    names = [f"k{k}" for k in range(len(keep))]
    kept = ", ".join(f"`{n}` {df.schema[c].dataType.simpleString()}" for n, c in zip(names, keep))
    plain = df.select(*[df[c].alias(n) for n, c in zip(names, keep)], df[text].alias("text"))
    out = plain.mapInArrow(run, f"{kept}, {schema}" if kept else schema)
    return out.withColumnsRenamed(dict(zip(names, keep)))


def filter_rows(df: DataFrame, text: str, keep: Callable[[Chunk], np.ndarray], lower: str = "") -> DataFrame:
    """Rows of ``df`` whose text ``keep`` approves of (a boolean a document); no column changes."""
    small_batches(df.sparkSession)
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [keep(chunk) for chunk in text_chunks(batch.column(at), lower)]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))

    return df.mapInArrow(run, StructType(df.schema.fields))
