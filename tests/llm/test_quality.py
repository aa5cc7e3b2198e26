import random

import numpy as np
import pandas as pd
from llm_data import clashing, words
from pyspark.sql import functions as F

from marketlake.llm import quality_classifier, quality_rules


def test_ledger_bits_and_policies(spark, make_docs):
    good = words(1, 60)
    texts = {1: good, 2: "too few words", 3: "spam " * 50, 4: good + " # $ % & * < > | " * 10,
             5: good.upper(), 6: "\n".join([words(2, 12)] * 9 + [words(3, 40)]), 7: None, 8: "", 9: good}
    docs = make_docs([(k, t, "s") for k, t in texts.items()], extra=True)
    rows = {r.doc_id: r for r in quality_rules.with_verdict(docs).collect()}
    failed = {k: {n for b, n in enumerate(quality_rules.RULE_NAMES) if r.fail_bits >> b & 1} for k, r in rows.items()}
    assert failed[1] == failed[9] == set()
    assert failed[2] == failed[7] == failed[8] == {"few_words"}
    assert {"repeated_windows", "one_word", "echoes"} <= failed[3]
    assert {"symbols", "bare_symbols"} <= failed[4] and failed[5] == {"capitals"}
    assert "duplicate_lines" in failed[6]
    assert {k for k, r in rows.items() if r.kept} == {1, 9}
    assert {k for k, r in rows.items() if r.base_failed} == {k for k, f in failed.items()
                                                             if f & {"few_words", "repeated_windows"}}


def test_ablation_counts_rows_rejected_by_one_rule_alone(spark, make_docs):
    rng = random.Random(1)
    texts = [rng.choice([words(k, 40), words(k, 3), "a " * 40, words(k, 40).upper()]) for k in range(60)]
    ledger = quality_rules.ledger(make_docs([(k, t, "s") for k, t in enumerate(texts)]))
    bits = [r.fail_bits & quality_rules.mask(quality_rules.POLICIES["v2"]) for r in ledger.collect()]
    for r in quality_rules.ablation(ledger, "v2").collect():
        bit = 1 << quality_rules.RULE_NAMES.index(r.rule)
        assert (r.failed, r.rejected_alone) == (sum(b & bit != 0 for b in bits), sum(b == bit for b in bits))


def _labelled(spark, make_docs, n=400):
    rng = random.Random(4)
    rows, labels = [], []
    for k in range(n):
        good = rng.random() < 0.6
        text = words(k, rng.randint(30, 80))
        rows.append((k, text if good else " ".join(w + "###" for w in text.split()), "s"))
        labels.append((k, int(good), 0))
    return make_docs(rows, extra=True), clashing(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_classifier_separates_held_out_documents(spark, make_docs):
    docs, labels = _labelled(spark, make_docs)
    found = quality_classifier.classify(docs, labels).join(labels.select("doc_id", "quality"), "doc_id").toPandas()
    held = found[found["held_out"]]
    assert 40 < len(held) < 130
    assert (held["predicted"] == held["quality"]).mean() > 0.98
    assert found["score"].between(0, 1).all()


def test_held_out_labels_are_never_read(spark, make_docs):
    docs, labels = _labelled(spark, make_docs, 150)
    held = quality_classifier.fold("doc_id", 5) == 0
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    score = lambda x: {r.doc_id: r.score for r in quality_classifier.classify(docs, x).collect()}
    a, b = score(labels), score(flipped)
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_normal_equations_equal_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, len(quality_classifier.FEATURES))).astype(np.float32)
    y = (x[:, 0] > 0).astype(float)
    train = spark.createDataFrame([(r.tolist(), float(v), False) for r, v in zip(x, y)],
                                  "features array<float>, label double, calibrate boolean").repartition(5)
    model = quality_classifier.fit(train, train)
    z = model.embed(x.astype(float))
    gram, right = quality_classifier._normal_equations(model, train)
    assert np.allclose(gram, z.T @ z) and np.allclose(right, z.T @ y)


def test_isotonic_levels_rise():
    bins = pd.DataFrame({"x": [0.1, 0.2, 0.3, 0.4], "n": [10, 10, 10, 10], "positive": [2, 6, 4, 9]})
    knots, levels = quality_classifier._isotonic(bins)
    assert knots.tolist() == [0.1, 0.25, 0.4] and np.all(np.diff(levels) >= 0)


def test_without_labels_and_rows(spark, make_docs):
    docs = make_docs([(1, "a b", "s"), (None, None, "s"), (2, "", "s"), (2, "", "s")])
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    found = quality_classifier.classify(docs, labels).collect()
    assert [r.score for r in found] == [0.5] * 4 and not any(r.held_out for r in found if r.doc_id is None)
    assert quality_classifier.classify(make_docs([]), labels).count() == 0
    assert quality_classifier.accepted(make_docs([], extra=True), labels).count() == 0


def test_accepted_keeps_all_columns(spark, make_docs):
    docs, labels = _labelled(spark, make_docs, 200)
    kept = quality_classifier.accepted(docs, labels)
    assert kept.columns == docs.columns
    chosen = {r.doc_id for r in quality_classifier.classify(docs, labels).collect() if r.predicted}
    assert {r.doc_id for r in kept.collect()} == chosen
