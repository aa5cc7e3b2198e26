"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

A benchmark item is found in a document where one of its rare word n-grams occurs; the
passage around the seed is aligned with the item by Smith-Waterman, so copies with
replaced, added or dropped words keep a high score.  Rare means rare among all documents:
a first pass counts the documents of every benchmark n-gram.  Benchmark items come in
blocks of bounded size, each of which is sent to all tasks and held against all
documents, so documents are never shuffled and a benchmark may be large.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.session import discard, materialize, written_table
from marketlake.llm.text import ALNUM, Chunk, filter_rows, ngrams, small_batches, text_chunks

SEED_WORDS = 3
#: An n-gram is rare if at most this share of all documents holds it, or if it is not much
#: more frequent than its item's other n-grams: up to RARE_TIMES their upper quartile.  So
#: every item keeps three quarters of its seeds, however often it was copied.
RARE_SHARE, RARE_TIMES = 0.0005, 4
MATCH, MISMATCH, GAP = 2, -1, -1
#: Alignment score over the best score of the item.
THRESHOLD = 0.5
#: Words of all items of a block, on average; bounds what is sent to a task.
BLOCK_WORDS = 1_000_000
#: Longest piece of a passage, in item lengths.  An alignment with a positive score covers
#: at most three item lengths, by which pieces overlap, so none is lost between two pieces.
PIECE, OVERLAP = 12, 3
#: Words that stand side by side in one alignment step, and places expanded at a time;
#: both bound a task's memory whatever the length of a text.
BATCH_WORDS, BATCH_PLACES = 1_000_000, 1_000_000


@dataclass
class Block:
    """Items as word hashes, and their seeds: sorted hashes with the places they come from."""

    ids: list
    words: list[np.ndarray]
    seeds: np.ndarray
    first: np.ndarray
    place_item: np.ndarray
    place_pos: np.ndarray

    def bitmap(self) -> np.ndarray:
        maybe = np.zeros(1 << 20, bool)
        maybe[(self.seeds >> np.uint64(44)).astype(np.int64)] = True
        return maybe


def _hashes(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, words = chunk.spans(ALNUM)
    return chunk.hashes(starts, ends), words


def _build(ids: list, words: list[np.ndarray]) -> Block:
    keys, item, pos = [], [], []
    for k, w in enumerate(words):
        edges = np.array([0, len(w)])
        found, at = ngrams(w, edges, min(SEED_WORDS, max(len(w), 1)))
        keys.append(found)
        item.append(np.full(len(found), k))
        pos.append(at)
    if not keys:
        none = np.zeros(0, np.int64)
        return Block(ids, words, np.zeros(0, np.uint64), np.zeros(1, np.int64), none, none)
    keys, item, pos = (np.concatenate(x) for x in (keys, item, pos))
    order = np.argsort(keys, kind="stable")
    seeds, first = np.unique(keys[order], return_index=True)
    return Block(ids, words, seeds, np.append(first, len(keys)), item[order], pos[order])


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
           block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """Items in blocks by a hash of the id; null texts have no words and match nothing."""
    items = benchmark.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    words = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    count = int(words // block_words) + 1
    for k in range(count):
        rows = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == k).collect()
        rows = sorted(rows, key=lambda r: (r["id"] is None, r["id"], r["text"]))
        found = []
        for chunk in text_chunks(pa.array([r["text"] for r in rows], pa.string()), lower="unicode"):
            hashes, edges = _hashes(chunk)
            found += [hashes[a:b] for a, b in zip(edges[:-1], edges[1:])]
        yield _build([r["id"] for r in rows], found)


def _seed_hits(block: Block, maybe: np.ndarray, chunk: Chunk) -> tuple:
    """(word hashes, word edges, seed number, word place) of every seed in the chunk.

    Items shorter than a seed have one seed, the whole item, so all lengths are looked up.
    """
    hashes, words = _hashes(chunk)
    seeds, places = [], []
    lengths = {min(SEED_WORDS, len(w)) for w in block.words if len(w)}
    for n in sorted(lengths):
        found, at = ngrams(hashes, words, n)
        hit = np.flatnonzero(maybe[(found >> np.uint64(44)).astype(np.int64)])
        k = np.minimum(np.searchsorted(block.seeds, found[hit]), len(block.seeds) - 1)
        same = block.seeds[k] == found[hit]
        seeds.append(k[same])
        places.append(at[hit[same]])
    none = np.zeros(0, np.int64)
    return hashes, words, np.concatenate([none, *seeds]), np.concatenate([none, *places])


def seed_counts(docs: DataFrame, block: Block, text_col: str = "text") -> tuple[np.ndarray, int]:
    """Documents that hold each seed, and all documents; one row a seed leaves a task."""
    maybe = block.bitmap()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(block.seeds), np.int64), 0
        for batch in batches:
            for chunk in text_chunks(batch.column(0), lower="unicode"):
                n += chunk.n_docs
                _, words, seed, place = _seed_hits(block, maybe, chunk)
                doc = np.searchsorted(words, place, "right") - 1
                pairs = np.unique(doc * len(block.seeds) + seed)
                total += np.bincount(pairs % len(block.seeds), minlength=len(block.seeds))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1)), pa.array(np.append(total[some], n))], ["seed", "n"])

    if not len(block.seeds):
        return np.zeros(0, np.int64), 0
    sums = docs.select(text_col).mapInArrow(run, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))
    found = dict(sums.toPandas().itertuples(index=False))
    n_docs = found.pop(-1, 0)
    counts = np.zeros(len(block.seeds), np.int64)
    counts[list(found)] = list(found.values())
    return counts, n_docs


def rare_only(block: Block, counts: np.ndarray, n_docs: int, share: float = RARE_SHARE) -> Block:
    """The block with the rare seeds of each item."""
    per_place = np.repeat(counts, np.diff(block.first))
    seed_of = np.repeat(np.arange(len(block.seeds)), np.diff(block.first))
    typical = np.zeros(len(block.words))
    order = np.argsort(block.place_item, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(block.place_item[order])) + 1):
        if len(part):
            typical[block.place_item[part[0]]] = np.sort(per_place[part])[(3 * len(part) - 1) // 4]
    keep = per_place <= np.maximum(RARE_TIMES * typical[block.place_item], max(share * n_docs, 1))
    used = np.unique(seed_of[keep])
    new = np.searchsorted(used, seed_of[keep])
    return Block(block.ids, block.words, block.seeds[used],
                 np.searchsorted(new, np.arange(len(used) + 1)),
                 block.place_item[keep], block.place_pos[keep])


def align(passages: list[np.ndarray], items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(best local score, end in the passage) of every passage with its item, side by side.

    Gaps cost the same a word, so a row's horizontal gaps are a running maximum.
    """
    rows, wide = max(map(len, passages)), max(map(len, items))
    a = np.zeros((len(passages), rows), np.uint64)
    b = np.ones((len(items), wide), np.uint64)
    real_a, real_b = np.zeros(a.shape, bool), np.zeros(b.shape, bool)
    for k, (p, q) in enumerate(zip(passages, items)):
        a[k, : len(p)], real_a[k, : len(p)] = p, True
        b[k, : len(q)], real_b[k, : len(q)] = q, True
    slope = -GAP * np.arange(wide + 1)
    last = np.zeros((len(passages), wide + 1), np.int32)
    best, end = np.zeros(len(passages), np.int32), np.zeros(len(passages), np.int64)
    for i in range(rows):
        same = (b == a[:, i: i + 1]) & real_b & real_a[:, i: i + 1]
        row = np.zeros_like(last)
        row[:, 1:] = np.maximum(last[:, :-1] + np.where(same, MATCH, MISMATCH), last[:, 1:] + GAP)
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + slope, axis=1) - slope
        top = row.max(axis=1)
        better = (top > best) & real_a[:, i]
        best[better], end[better] = top[better], i + 1
        last = row.astype(np.int32)
    return best, end


def _merged(doc: np.ndarray, item: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """(doc, item, from, to) of word ranges, of which those that overlap are one."""
    order = np.lexsort((begin, item, doc))
    doc, item, begin, stop = doc[order], item[order], begin[order], stop[order]
    if not len(doc):
        return np.zeros((0, 4), np.int64)
    pair = np.zeros(len(doc), np.int64)
    pair[1:] = np.cumsum((doc[1:] != doc[:-1]) | (item[1:] != item[:-1]))
    # The furthest end so far inside each pair: pairs ascend, so one running maximum does.
    step = int(stop.max()) + 1
    reach = np.maximum.accumulate(pair * step + stop) - pair * step
    new = np.ones(len(doc), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (begin[1:] >= reach[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return np.column_stack([doc[first], item[first], begin[first], reach[last]])


def _ranges(block: Block, sizes: np.ndarray, words: np.ndarray, at: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Merged word ranges around seeds: ``at`` is the seed's place in the benchmark."""
    item = block.place_item[at]
    doc = np.searchsorted(words, place, "right") - 1
    slack = sizes[item] // 4 + 2
    begin = np.maximum(place - block.place_pos[at] - slack, words[doc])
    stop = np.minimum(place - block.place_pos[at] + sizes[item] + slack, words[doc + 1])
    return _merged(doc, item, begin, stop)


def _candidates(block: Block, words: np.ndarray, seed: np.ndarray, place: np.ndarray) -> Iterator[np.ndarray]:
    """(doc, item, from, to) word ranges around seeds, all ranges of a pair in one array.

    A seed stands for all its places in the benchmark.  Items are taken in groups, and the
    places of a group in slices, of about ``BATCH_PLACES``; ranges of slices are merged.
    """
    sizes = np.array([len(w) for w in block.words], np.int64)
    seed_of = np.repeat(np.arange(len(block.seeds)), np.diff(block.first))
    order = np.argsort(seed, kind="stable")
    seed, place = seed[order], place[order]
    begin, end = np.searchsorted(seed, seed_of), np.searchsorted(seed, seed_of, "right")
    hits = end - begin
    load = np.cumsum(np.bincount(block.place_item, weights=hits, minlength=len(sizes)))
    group = (np.maximum(load - 1, 0) // BATCH_PLACES).astype(np.int64)[block.place_item]
    used = np.flatnonzero(hits)
    for g in np.unique(group[used]):
        mine = used[group[used] == g]
        upto = np.cumsum(hits[mine])
        parts = []
        for low in range(0, int(upto[-1]), BATCH_PLACES):
            k = np.arange(low, min(low + BATCH_PLACES, int(upto[-1])))
            j = np.searchsorted(upto, k, "right")
            at = mine[j]
            parts.append(_ranges(block, sizes, words, at, place[end[at] - (upto[j] - k)]))
        yield _merged(*np.concatenate(parts).T) if len(parts) > 1 else parts[0]


def _pieces(ranges: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ranges, long ones cut into overlapping pieces, pieces of like length together."""
    item = ranges[:, 1]
    length, step = ranges[:, 3] - ranges[:, 2], (PIECE - OVERLAP) * sizes[item]
    count = np.maximum(-(-(length - OVERLAP * sizes[item]) // step), 1)
    out = np.repeat(ranges, count, axis=0)
    k = np.arange(len(out)) - np.repeat(np.cumsum(count) - count, count)
    out[:, 2] += k * np.repeat(step, count)
    out[:, 3] = np.minimum(out[:, 3], out[:, 2] + PIECE * np.repeat(sizes[item], count))
    return out[np.argsort(out[:, 3] - out[:, 2], kind="stable")]


def _batches(pieces: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Runs of pieces that, padded to the longest, stay within ``BATCH_WORDS`` (or one piece)."""
    length, wide = (pieces[:, 3] - pieces[:, 2]).tolist(), sizes[pieces[:, 1]].tolist()
    low, widest = 0, 0
    for k in range(len(pieces)):
        if k > low and (k - low + 1) * (length[k] + 4 * max(widest, wide[k])) > BATCH_WORDS:
            yield pieces[low:k]
            low, widest = k, 0
        widest = max(widest, wide[k])
    if len(pieces):
        yield pieces[low:]


def find(block: Block, maybe: np.ndarray, chunk: Chunk, threshold: float) -> list[tuple]:
    """(doc, item, score, first word, end word) of every aligned pair of the chunk, best place each.

    Of places with the same score the one that ends first counts.  Memory follows the words
    of the chunk and the two batch bounds, not the number of items that a text repeats.
    """
    hashes, words, seed, place = _seed_hits(block, maybe, chunk)
    if not len(seed):
        return []
    sizes = np.array([len(w) for w in block.words], np.int64)
    best: dict[tuple, tuple] = {}
    for ranges in _candidates(block, words, seed, place):
        for part in _batches(_pieces(ranges, sizes), sizes):
            passages = [hashes[x:y] for _, _, x, y in part]
            items = [block.words[i] for i in part[:, 1]]
            scores, ends = align(passages, items)
            share = scores / (MATCH * sizes[part[:, 1]])
            for j in np.flatnonzero(share >= threshold):
                d, i, x, _ = part[j].tolist()
                rank = (-float(share[j]), int(x - words[d] + ends[j]))
                if (d, i) not in best or rank < best[d, i][0]:
                    best[d, i] = rank, passages[j][: ends[j]]
    out = []
    for (d, i), ((score, end), upto) in sorted(best.items(), key=lambda kv: kv[0]):
        _, back = align([upto[::-1]], [block.words[i][::-1]])
        out.append((d, i, -score, end - int(back[0]), end))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, score, first_word, end_word): every leaked item of every document.

    Words are runs of digits, letters and non-ASCII characters in lower case, counted
    from 0; ``end_word`` is exclusive.  Null and empty texts match nothing; repeated rows
    give repeated pairs, and of an item's places in a document the best, then first, counts.
    A very long text is aligned in pieces, with the same result.  The pairs of a block are
    written before the next block is built, so the driver holds one block at a time.
    """
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, item_id {item_type}, score double, first_word long, end_word long"
    small_batches(docs.sparkSession)
    parts = []
    for block in _rare_blocks(docs, benchmark, text_col):
        pairs = docs.select(id_col, text_col).mapInArrow(_pairs(block, threshold, id_col), schema)
        parts.append(materialize(pairs, "leaked_pairs"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _rare_blocks(docs: DataFrame, benchmark: DataFrame, text_col: str) -> Iterator[Block]:
    for block in blocks(benchmark, block_words=BLOCK_WORDS):
        yield rare_only(block, *seed_counts(docs, block, text_col))


def _pairs(block: Block, threshold: float, id_col: str):
    maybe = block.bitmap()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch.column(1), lower="unicode"):
                found = find(block, maybe, chunk, threshold) if len(block.seeds) else []
                if found:
                    doc, item, score, first, end = zip(*found)
                    ids = batch.column(0).take(pa.array([chunk.first_row + d for d in doc]))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array([block.ids[i] for i in item]), pa.array(score), pa.array(first),
                         pa.array(end)], [id_col, "item_id", "score", "first_word", "end_word"])

    return run


def without_contaminated(docs: DataFrame, benchmark: DataFrame,
                         threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that hold no benchmark item; all columns stay as they are.

    What a block leaves is written before the block after the next is built, so the driver
    holds two blocks at most and no task runs more than one; a benchmark of one block, up to
    ``BLOCK_WORDS``, writes nothing.  Of the written tables only the last is left.
    """
    spark, kept, written = docs.sparkSession, docs, None
    for k, block in enumerate(_rare_blocks(docs, benchmark, "text")):
        if k:
            kept, path = written_table(kept, "clean_docs")
            if written:
                discard(spark, written)
            written = path
        kept = filter_rows(kept, "text", _clean(block, threshold), lower="unicode")
    return kept


def _clean(block: Block, threshold: float) -> Callable[[Chunk], np.ndarray]:
    maybe = block.bitmap()

    def keep(chunk: Chunk) -> np.ndarray:
        clean = np.ones(chunk.n_docs, bool)
        for doc, *_ in find(block, maybe, chunk, threshold) if len(block.seeds) else []:
            clean[doc] = False
        return clean

    return keep
