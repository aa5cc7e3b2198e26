"""Measurements of whole texts that quality rules and the quality classifier share."""

from __future__ import annotations

import numpy as np

from marketlake.llm.text import (
    NOT_SPACE, Chunk, byte_class, doc_of, mix, ngrams, per_doc, repeated,
)

_SYMBOL = byte_class(lambda b: b < 128 and chr(b) in "#*$%&|<>")
_UPPER = byte_class(lambda b: 65 <= b <= 90)
_LOWER = byte_class(lambda b: 97 <= b <= 122)
_DIGIT = byte_class(lambda b: 48 <= b <= 57)
_SHOUT = byte_class(lambda b: b == 33)
_STOP = byte_class(lambda b: b < 128 and chr(b) in ".,;:?")
_HIGH = byte_class(lambda b: b >= 128)
_HEAD = byte_class(lambda b: b & 0xC0 != 0x80)

#: name -> Spark type of every measurement.
STATS = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
    "n_repeat_words": "long", "n_lines": "long", "n_upper": "long", "n_lower": "long",
    "n_digits": "long", "n_shouts": "long", "n_stops": "long", "n_high": "long",
    "n_short_words": "long", "n_distinct_words": "long", "n_top_word": "long",
    "n_bare_symbols": "long", "longest_word": "long", "n_echoes": "long",
}
SCHEMA = ", ".join(f"{k} {v}" for k, v in STATS.items())


def _most_frequent(keys: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, rows of the most frequent key) of every document."""
    _, at, counts = np.unique(keys, return_index=True, return_counts=True)
    top = np.zeros(n_docs, np.int64)
    np.maximum.at(top, doc[at], counts)
    return np.bincount(doc[at], minlength=n_docs), top


def measure(chunk: Chunk) -> dict[str, np.ndarray]:
    """Every measurement of every document of the chunk.

    Words are maximal runs without space and \\t \\n \\v \\f \\r; lines lie between \\n.
    Equality of words, lines and windows is that of 64-bit hashes salted by document.
    """
    n = chunk.n_docs
    data, edges = chunk.data, chunk.edges
    starts, ends, words = chunk.spans(NOT_SPACE)
    doc = doc_of(words)
    inside = NOT_SPACE[data]
    count = lambda flags: per_doc(flags, edges)
    heads = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_HEAD[data] & inside, out=heads[1:])
    length = heads[ends] - heads[starts]

    line_starts, line_ends, lines = chunk.lines()
    line_doc = doc_of(lines)
    with_word = heads[line_ends] > heads[line_starts]
    salt = mix(np.arange(n, dtype=np.uint64) + np.uint64(77))
    line_key = mix(chunk.hashes(line_starts[with_word], line_ends[with_word])
                   ^ salt[line_doc[with_word]])
    _, first = np.unique(line_key, return_index=True)
    full_lines = np.bincount(line_doc[with_word], minlength=n)
    distinct_lines = np.bincount(line_doc[with_word][first], minlength=n)

    word_hash = chunk.hashes(starts, ends)
    five, at = ngrams(word_hash, words, 5)
    twice = at[repeated(mix(five ^ salt[doc[at]]))]
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.subtract.at(cover, twice + 5, 1)
    covered = np.cumsum(cover)[:-1] > 0

    distinct, top = _most_frequent(mix(word_hash ^ salt[doc]), doc, n)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, doc, length)
    echo = np.zeros(len(starts), bool)
    echo[1:] = (word_hash[1:] == word_hash[:-1]) & (doc[1:] == doc[:-1])
    bare = (ends - starts == 1) & _SYMBOL[data[starts]]
    return {
        "n_words": np.diff(words).astype(np.int64), "word_chars": count(_HEAD[data] & inside),
        "n_symbols": count(_SYMBOL[data]),
        "n_dup_lines": (full_lines - distinct_lines).astype(np.int64),
        "n_repeat_words": per_doc(covered, words), "n_lines": full_lines.astype(np.int64),
        "n_upper": count(_UPPER[data]), "n_lower": count(_LOWER[data]),
        "n_digits": count(_DIGIT[data]), "n_shouts": count(_SHOUT[data]),
        "n_stops": count(_STOP[data]), "n_high": count(_HIGH[data]),
        "n_short_words": per_doc(length <= 3, words), "n_distinct_words": distinct.astype(np.int64),
        "n_top_word": top, "n_bare_symbols": per_doc(bare, words), "longest_word": longest,
        "n_echoes": per_doc(echo, words),
    }
