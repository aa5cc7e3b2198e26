import random

import numpy as np
from llm_data import clashing, words
from pyspark.sql import functions as F

from marketlake.llm import toxicity


def _corpus(spark, make_docs, n=500):
    rng = random.Random(7)
    rows, labels = [], []
    for k in range(n):
        bad = rng.random() < 0.3
        w = words(k, rng.randint(20, 60)).split()
        for _ in range(rng.randint(1, 3) if bad else 0):
            w.insert(rng.randint(0, len(w)), rng.choice(["vile", "Awful!", "nasty"]) + rng.choice(["", "est"]))
        rows.append((k, " ".join(w), "s"))
        labels.append((k, int(bad)))
    return make_docs(rows, extra=True), clashing(spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_held_out_documents(spark, make_docs):
    docs, labels = _corpus(spark, make_docs)
    found = toxicity.classify(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").toPandas()
    held = found[found["held_out"]]
    assert 100 < len(held) < 230
    assert (held["predicted"] == held["toxic"]).mean() > 0.95
    assert ((held["predicted"] == 1) & (held["toxic"] == 0)).mean() < 0.02


def test_held_out_labels_are_never_read(spark, make_docs):
    docs, labels = _corpus(spark, make_docs, 200)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda x: {r.doc_id: r.score for r in toxicity.classify(docs, x).collect()}
    assert score(labels) == score(flipped)


def test_ftrl_gives_sparse_weights():
    rng = np.random.default_rng(1)
    docs = [np.unique(rng.integers(10, 2000, 30)).astype(np.uint64) for _ in range(400)]
    labels = rng.integers(0, 2, 400)
    docs = [np.append(d, np.uint64(1)) if y else d for d, y in zip(docs, labels)]
    keys, weights, _ = toxicity._ftrl(docs, labels.astype(float), 0)
    assert keys[np.argmax(weights)] == 1 and len(keys) < 100


def test_sample_is_bounded_and_balanced(spark):
    labels = spark.createDataFrame([(k, int(k % 10 == 0)) for k in range(1000)], "doc_id long, toxic int")
    sample, share = toxicity.sample_labelled(labels, F.lit(False), rows=60)
    assert dict(sample.groupBy("label").count().collect()) == {0: 60, 1: 60}
    assert share.first()[0] == 0.1


def test_degenerate_tables(spark, make_docs):
    docs = make_docs([(1, None, "s"), (None, "vile", "s"), (2, "", "s"), (2, "", "s"), (4, words(1, 30_000), "s")])
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    found = toxicity.classify(docs, none).collect()
    assert [r.score for r in found] == [0.5] * 5 and [r.predicted for r in found] == [0] * 5
    assert toxicity.classify(make_docs([]), none).count() == 0
    one = spark.createDataFrame([(2, 0), (4, 0)], "doc_id long, toxic int")
    assert all(0 <= r.score <= 1 for r in toxicity.classify(docs, one).collect())
