"""License scans by a positional index of rare template words.

The words of some license notices are the index: (word, template, position, weight),
weighed by how few documents of the whole corpus hold the word.  A document is looked up
by the rarest words of the key phrases only, the licence words of highest weight that a
verified notice cannot be without, so no notice is missed in any corpus.  Each such place
proposes where a template would begin, the other words of the template are met at their
relative positions, and a template counts if enough of its weight is there and its key
phrase stands word for word.
Everything is built-in functions over a row's word array, so nothing is shuffled but one
count a template word.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a text whose A-Z were lowered.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Phrase -> label; every place counts.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: (label, notice, key phrase that must stand word for word): fixed values.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    ("gpl", "gnu general public license as published by the free software foundation",
     "general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license",
     "creative commons attribution"),
    ("cc0", "dedicated to the public domain under creative commons zero", "public domain"),
    ("reserved", "copyright all rights reserved", "all rights reserved"),
]

#: Part of a template's weight that must stand at its place.
LEAST_SHARE = 0.5


@dataclass
class Index:
    """Weights of the template words, and the anchors, (word, place): the rarest word of every
    template's key phrase, with its place in the template, and of every base phrase."""

    weights: dict[str, float]
    anchors: list[tuple[str, int]]
    base_anchors: list[tuple[str, int]]


def _words(phrase: str) -> list[str]:
    return phrase.split()


def _key_place(notice: str, key: str) -> int:
    """The word of the notice at which its key phrase begins."""
    template, phrase = _words(notice), _words(key)
    return next(k for k in range(len(template)) if template[k: k + len(phrase)] == phrase)


def _lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())


def _literal(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def vocabulary() -> list[str]:
    return sorted({w for _, notice, _ in TEMPLATES for w in _words(notice)}
                  | {w for phrase in BASE for w in _words(phrase)})


def build_index(docs: DataFrame, text_col: str = "text") -> Index:
    """Count the documents of every template word over all texts; one row a word reaches the driver."""
    words = F.regexp_extract_all(_lowered(F.col(text_col)), F.lit(WORD), F.lit(0))
    held = docs.select(F.array_intersect(words, _literal(vocabulary())).alias("held"))
    # The null entry counts the documents.
    counts = dict(held.select(F.explode(F.concat("held", F.array(F.lit(None).cast("string")))).alias("word"))
                  .groupBy("word").count().collect())
    total = counts.pop(None, 0)
    weights = {w: math.log((total + 1) / (counts.get(w, 0) + 1)) + 0.1 for w in vocabulary()}

    def rarest(phrase: str, first: int = 0) -> tuple[str, int]:
        k, word = min(enumerate(_words(phrase)), key=lambda p: (counts.get(p[1], 0), p[0]))
        return word, first + k

    anchors = [rarest(key, _key_place(notice, key)) for _, notice, key in TEMPLATES]
    return Index(weights, anchors, [rarest(phrase) for phrase in BASE])


def _stands(words: Column, at: Column, phrase: list[str]) -> Column:
    """Whether the phrase stands at word ``at``; places outside the text do not match."""
    same = [F.coalesce(F.get(words, at + k) == w, F.lit(False)) for k, w in enumerate(phrase)]
    out = same[0]
    for s in same[1:]:
        out = out & s
    return out


def _phrase_at(words: Column, phrase: list[str]) -> Callable[[Column], Column]:
    return lambda i: _stands(words, i, phrase)


def _back(k: int) -> Callable[[Column], Column]:
    return lambda i: i - k


def _best_share(words: Column, hits: Column, index: Index, number: int) -> Column:
    """Largest aligned weight share of a template with its key phrase in place, else 0."""
    _, notice, key = TEMPLATES[number]
    template, phrase = _words(notice), _words(key)
    offset = _key_place(notice, key)
    weight = [index.weights[w] for w in template]
    anchor, at = index.anchors[number]
    starts = F.transform(F.filter(hits, _phrase_at(words, [anchor])), _back(at))

    def share(start: Column) -> Column:
        there = [F.when(F.get(words, start + k) == w, F.lit(weight[k])).otherwise(F.lit(0.0))
                 for k, w in enumerate(template)]
        total = there[0]
        for t in there[1:]:
            total = total + t
        return F.when(_stands(words, start + offset, phrase), total / F.lit(sum(weight))).otherwise(F.lit(0.0))

    return F.coalesce(F.array_max(F.transform(starts, share)), F.lit(0.0))


def scan(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score), a row a row.

    ``n_base`` counts the places of base phrases; the first and last start are null
    without one.  ``labels`` adds the labels of verified templates to the base ones;
    ``score`` is 1 for a base phrase, else the best aligned share.  Null and empty texts
    have no words and score 0; other columns are not read.
    """
    anchor_words = sorted({w for w, _ in [*index.anchors, *index.base_anchors]})
    words = F.regexp_extract_all(_lowered(docs[text_col]), F.lit(WORD), F.lit(0))
    # One-row generators keep an array computed once from being recomputed inside lambdas.
    rows = docs.select(docs[id_col].alias("id"), F.explode(F.array(words)).alias("words"))
    held = F.array_intersect("words", _literal(anchor_words))
    looked_up = F.when(F.size(held) > 0, F.filter(
        F.sequence(F.lit(0), F.size("words") - 1),
        lambda i: F.array_contains(_literal(anchor_words), F.get(F.col("words"), i))))
    rows = rows.select("id", "words", F.explode(F.array(F.coalesce(looked_up, F.array().cast("array<int>"))))
                       .alias("hits"))
    w, hits = F.col("words"), F.col("hits")
    base = []
    for (phrase, label), (anchor, k) in zip(BASE.items(), index.base_anchors):
        starts = F.transform(F.filter(hits, _phrase_at(w, [anchor])), _back(k))
        base.append((label, F.filter(starts, _phrase_at(w, _words(phrase)))))
    some = F.size(hits) > 0
    found = rows.select(
        "id", F.size("words").cast("long").alias("n_words"),
        *[F.when(some, places).otherwise(F.array().cast("array<int>")).alias(f"base{k}")
          for k, (_, places) in enumerate(base)],
        *[F.when(some, _best_share(w, hits, index, k)).otherwise(F.lit(0.0)).alias(f"share{k}")
          for k in range(len(TEMPLATES))],
    )
    places = F.concat(*[F.col(f"base{k}") for k in range(len(base))])
    none = F.lit(None).cast("string")
    base_labels = F.array_compact(F.array(*[
        F.when(F.size(f"base{k}") > 0, F.lit(label)).otherwise(none) for k, (label, _) in enumerate(base)]))
    own = F.array_compact(F.array(*[
        F.when(F.col(f"share{k}") >= LEAST_SHARE, F.lit(label)).otherwise(none)
        for k, (label, _, _) in enumerate(TEMPLATES)]))
    best = F.greatest(*[F.when(F.col(f"share{k}") >= LEAST_SHARE, F.col(f"share{k}")).otherwise(F.lit(0.0))
                        for k in range(len(TEMPLATES))])
    return found.select(
        F.col("id").alias(id_col), "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, own))), ",").alias("labels"),
        F.when(F.size(places) > 0, F.lit(1.0)).otherwise(F.least(best, F.lit(1.0))).alias("score"),
    )
