"""Suffix arrays of byte pieces in numpy, and the content hashes around them."""

from __future__ import annotations

import numpy as np

from marketlake.llm.text import mix

_SYMBOLS, _SYMBOL_BITS = 7, 9
_RANDOM = np.random.default_rng(411).integers(1, 1 << 63, 256 + 16, dtype=np.uint64) | np.uint64(1)
#: Kasai's walk runs in this many lanes at most, each over bytes that follow each other.
LANES = 4096


def byte_grams(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes (a power of two) from every place."""
    out, n, step = _RANDOM[data], 1, 256
    while n < width:
        out = out[:-n] * _RANDOM[step] + out[n:]
        n, step = 2 * n, step + 1
    return mix(out)


def sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` (minimum or maximum) over every run of ``width`` values."""
    n = 1
    while 2 * n <= width:
        values = best(values[:-n], values[n:])
        n *= 2
    return best(values[: len(values) - (width - n)], values[width - n:]) if n < width else values


def suffix_array(data: np.ndarray, stop: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of the first ``depth`` bytes (or a few more) of their suffixes, by
    Larsson and Sadakane's refinement.

    A suffix ends at ``stop`` of its place, the end of its piece; suffixes that are equal so
    far stand in the order of their places.  Each round doubles the sorted width and sorts
    again only the groups that are still tied, by the rank of what follows.
    """
    n = len(data)
    key = np.zeros(n, np.int64)
    place = np.arange(n, dtype=np.int32)
    for k in range(_SYMBOLS):
        key <<= _SYMBOL_BITS
        inside = np.flatnonzero(place + k < stop)
        key[inside] += data[inside + k].astype(np.int64) + 1
    order = np.argsort(key).astype(np.int32)
    rank = np.empty(n, np.int32)
    at, key = place, key[order]
    width = _SYMBOLS
    while True:
        # ``at``: the sorted places in play, ``key``: what they were sorted by.
        new = np.ones(len(at) + 1, bool)
        new[1:-1] = key[1:] != key[:-1]
        first = np.flatnonzero(new[:-1])
        rank[order[at]] = at[np.repeat(first, np.diff(np.append(first, len(at))))]
        tied = ~(new[:-1] & new[1:])
        at = at[tied]
        if not len(at) or width >= depth:
            # Tied to the end: the groups stay, their places ascend.
            ends = np.argsort(rank[order[at]].astype(np.int64) * n + order[at])
            order[at] = order[at][ends]
            return order
        own = order[at]
        after = own + width
        live = after < stop[own]
        # Suffixes that end here come first; they are equal and stay in the order of their places.
        key = rank[own].astype(np.int64) * (2 * n) + np.where(live, n + rank[np.where(live, after, 0)], own)
        sort = np.argsort(key)
        order[at], key = own[sort], key[sort]
        width *= 2


def common_prefixes(data: np.ndarray, stop: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For every place, the bytes its suffix shares with the one before it in ``order``, up to ``most``.

    ``order`` is sorted by ``most`` bytes at least.  Kasai's walk: a place shares at least one
    byte less than the place before it, if the two suffixes that follow stand in the same
    order; where a tie has put them the other way, the walk begins anew.  The walk over all
    places is cut into lanes that advance side by side.
    """
    n = len(data)
    out = np.zeros(n, np.int16 if most < 1 << 15 else np.int64)
    before = np.full(n + 1, -1, np.int32)
    before[order[1:]] = order[:-1]
    rank = np.empty(n + 1, np.int32)
    rank[order] = np.arange(n, dtype=np.int32)
    rank[n] = n
    step = max(-(-n // LANES), 256)
    at = np.arange(0, n, step)
    end = np.minimum(at + step, n)
    shared = np.zeros(len(at), np.int64)
    while len(at):
        other = before[at]
        room = np.minimum(np.minimum(stop[at] - at, stop[other] - other), most)
        room[other < 0] = 0
        shared = np.minimum(shared, room)
        more = shared < room
        here = np.where(more, shared, 0)
        more &= data[at + here] == data[other + here]
        out[at[~more]] = shared[~more]
        turned = rank[other + 1] > rank[at + 1]
        shared = np.where(more, shared + 1, np.where(turned, 0, np.maximum(shared - 1, 0)))
        at = at + ~more
        open_ = at < end
        if not open_.all():
            at, end, shared = at[open_], end[open_], shared[open_]
    return out


def covered(starts: np.ndarray, width: int | np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` bytes lie in one of the ranges from ``starts``."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return np.cumsum(edges[:-1]) > 0


def runs(flags: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the maximal runs of true flags, cut at ``edges``."""
    before = np.zeros(len(flags), bool)
    before[1:] = flags[:-1]
    after = np.zeros(len(flags), bool)
    after[:-1] = flags[1:]
    inner = edges[1:-1]
    inner = inner[(inner > 0) & (inner < len(flags))]
    before[inner] = False
    after[inner - 1] = False
    return np.flatnonzero(flags & ~before), np.flatnonzero(flags & ~after) + 1
