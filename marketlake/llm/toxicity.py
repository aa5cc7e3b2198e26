"""Toxicity by FTRL-proximal logistic regression over hashed n-grams and skip-grams.

A text is the set of its hashed words, word pairs and skip-pairs.  Learners run in
parallel on shards of a bounded, class-balanced sample of labelled rows; each keeps its
own per-coordinate rates, and L1 drives every feature without steady evidence to zero.
The shards' weights are averaged by Spark into a short sorted list that every scoring
task receives, so scoring all texts is one pass without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.text import ALNUM, Chunk, doc_of, map_chunks, mix, ngrams, text_chunks
from marketlake.session import materialize

#: Labelled rows of each class that training reads at most, the first by a hash of the id.
MAX_ROWS_PER_CLASS = 6000
#: Learners work on shards of about this many rows, so there are at most four.
ROWS_PER_SHARD = 3000
EPOCHS = 12
#: Features live in a space of 2**FEATURE_BITS hash values.
FEATURE_BITS = 44
STEM_BYTES = (4, 5, 6, 7)
#: Features of fewer documents of a shard are left out of its learner.
LEAST_DOCS = 4
ALPHA, BETA, L1, L2 = 4.0, 1.0, 10.0, 0.0


@dataclass
class ToxicityModel:
    """Sorted feature hashes with non-zero weight, and the intercept."""

    keys: np.ndarray
    weights: np.ndarray
    intercept: float


def _features(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(feature hash, document) of every word, word pair, skip-pair and longer word's stem.

    Stems, the first bytes of a word, let a weight learnt on some inflections of a word
    reach the others.
    """
    starts, ends, words = chunk.spans(ALNUM)
    doc = doc_of(words)
    one = chunk.hashes(starts, ends)
    two, at_two = ngrams(one, words, 2)
    three, at = ngrams(one, words, 3)
    skip = mix(one[at] * np.uint64(0xA24BAED4963EE407) + mix(one[at + 2] + np.uint64(9)))
    kinds = [one, mix(two + np.uint64(1)), skip]
    places = [doc, doc[at_two], doc[at]]
    for length in STEM_BYTES:
        longer = np.flatnonzero(ends - starts > length)
        stem = chunk.hashes(starts[longer], starts[longer] + length)
        kinds.append(mix(stem + np.uint64(100 + length)))
        places.append(doc[longer])
    return np.concatenate(kinds) >> np.uint64(64 - FEATURE_BITS), np.concatenate(places)


def _ftrl(docs: list[np.ndarray], labels: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(keys, weights, intercept) of one learner over documents given as sets of keys.

    A feature of a few documents cannot outgrow L1, so rarer ones are left out at once.
    """
    flat = np.concatenate(docs) if docs else np.zeros(0, np.uint64)
    keys, code, counts = np.unique(flat, return_inverse=True, return_counts=True)
    frequent = counts >= LEAST_DOCS
    place = np.cumsum(frequent) - 1
    keys = keys[frequent]
    rows, at = [], 0
    for d in docs:
        own = code[at: at + len(d)]
        rows.append(place[own[frequent[own]]])
        at += len(d)
    z, n = np.zeros(len(keys)), np.zeros(len(keys))
    bias_z = bias_n = 0.0
    bias = 0.0
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            own = rows[k]
            zk, nk = z[own], n[own]
            shrunk = np.sign(zk) * np.maximum(np.abs(zk) - L1, 0)
            w = -shrunk / ((BETA + np.sqrt(nk)) / ALPHA + L2)
            bias = -bias_z / ((BETA + np.sqrt(bias_n)) / ALPHA)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35)))
            g = p - labels[k]
            grown = np.sqrt(nk + g * g)
            z[own] = zk + g - (grown - np.sqrt(nk)) / ALPHA * w
            n[own] = nk + g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / ALPHA * bias
            bias_n += g * g
    shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
    w = -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)
    used = w != 0
    return keys[used], w[used], float(-bias_z / ((BETA + np.sqrt(bias_n)) / ALPHA))


def _learn(shard: pd.DataFrame) -> pd.DataFrame:
    shard = shard.sort_values("place")
    docs = []
    for chunk in text_chunks(pa.array(shard["text"]), lower="unicode"):
        keys, doc = _features(chunk)
        order = np.argsort(doc, kind="stable")
        for part in np.split(keys[order], np.cumsum(np.bincount(doc, minlength=chunk.n_docs))[:-1]):
            docs.append(np.unique(part))
    keys, weights, bias = _ftrl(docs, shard["label"].to_numpy(float), int(shard["shard"].iloc[0]))
    return pd.DataFrame({
        "feature": np.concatenate([keys.astype(np.int64), [-1]]),
        "weight": np.concatenate([weights, [bias]]),
    })


def sample_labelled(labels: DataFrame, held_out: Column, label: str = "toxic",
                    id_col: str = "doc_id",
                    rows: int = MAX_ROWS_PER_CLASS) -> tuple[DataFrame, DataFrame]:
    """(sample, share): at most ``rows`` labelled ids of each class, the first by a hash of
    the id, with label and place; and the part of positives among all labelled ids,
    which corrects the intercept for the balanced sample.  An id with several labels takes
    the larger one.
    """
    known = materialize(
        labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull()).filter(~held_out)
        .groupBy(id_col).agg(F.max(F.col(label).cast("int")).alias("label")), "toxic-labels")
    place = F.xxhash64(F.lit("toxicity"), F.col(id_col)).alias("place")
    picked = [
        known.filter(F.col("label") == k).select(id_col, "label", place).orderBy("place", id_col).limit(rows)
        for k in (0, 1)
    ]
    return picked[0].unionByName(picked[1]), known.agg(F.avg("label").alias("share"))


def fit(docs: DataFrame, labels: DataFrame, held_out: Column) -> ToxicityModel:
    """Train on labelled documents outside the held-out fold; without any, scores are 0.5.

    The sample has at most ``2 * MAX_ROWS_PER_CLASS`` ids, which bounds the broadcast,
    each shard and the weights that reach the driver.
    """
    sample, share = sample_labelled(labels, held_out)
    sample = materialize(sample, "toxic-sample")
    counts = dict(sample.groupBy("label").count().collect())
    shards = -(-sum(counts.values()) // ROWS_PER_SHARD)
    if not shards:
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), 0.0)
    sample = sample.withColumn("shard", F.pmod(F.col("place"), F.lit(shards)).cast("int"))
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    # One text an id, so that a shard stays bounded when ids repeat.
    rows = rows.groupBy("doc_id", "label", "shard", "place").agg(F.max("text").alias("text"))
    learnt = rows.groupBy("shard").applyInPandas(_learn, "feature long, weight double")
    found = learnt.groupBy("feature").agg(F.sum("weight").alias("weight")).toPandas()
    base = share.first()["share"]
    bias = float(found.loc[found["feature"] == -1, "weight"].sum()) / shards
    if counts.get(0) and counts.get(1):
        bias += np.log(base / (1 - base)) - np.log(counts[1] / counts[0])
    kept = found[found["feature"] != -1].sort_values("feature")
    return ToxicityModel(kept["feature"].to_numpy().astype(np.uint64),
                         kept["weight"].to_numpy() / shards, bias)


def score(docs: DataFrame, model: ToxicityModel, keep: list[str]) -> DataFrame:
    """``keep`` and ``score`` of every row; a null or empty text scores as the intercept."""
    low = np.uint64((1 << 20) - 1)
    maybe = np.zeros(1 << 20, bool)
    maybe[(model.keys & low).astype(np.int64)] = True

    def work(chunk: Chunk) -> dict[str, np.ndarray]:
        keys, doc = _features(chunk)
        total = np.full(chunk.n_docs, model.intercept)
        if len(model.keys):
            hit = np.flatnonzero(maybe[(keys & low).astype(np.int64)])
            at = np.minimum(np.searchsorted(model.keys, keys[hit]), len(model.keys) - 1)
            same = model.keys[at] == keys[hit]
            pairs = np.unique(np.column_stack([doc[hit[same]], at[same]]), axis=0)
            np.add.at(total, pairs[:, 0], model.weights[pairs[:, 1]])
        return {"score": 1 / (1 + np.exp(-np.clip(total, -35, 35)))}

    return map_chunks(docs, keep, "text", work, "score double", lower="unicode")


def classify(docs: DataFrame, labels: DataFrame, parts: int = 3, held: int = 1,
             threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; null ids are never held out."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    held_out = F.coalesce(crc % parts == held, F.lit(False))
    model = fit(docs, labels, held_out)
    return score(docs, model, ["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))

