import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_data import clashing
from pyspark.sql import functions as F

from marketlake.llm import divergence

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain(rows, least=10, top=10):
    count, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        count[lang, source].update(found)
        held[lang].update(set(found))
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for t, n in held[lang].items() if n >= least]
        sources = [s for x, s in groups if x == lang]

        def shares(counter):
            total = sum(counter[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counter[t] + 2) // total for t in kept}

        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])) for t in kept
                     if count[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(ranked, 1)]
    return sorted(out)


def rows_of(n, seed):
    rng = random.Random(seed)
    vocabulary = ["Alpha", "beta", "été", "İx", "don't", "a1b", "γάμμα", *[f"w{chr(97 + k)}" for k in range(20)]]
    rows = []
    for k in range(n):
        text = rng.choice([None, "", " ".join(rng.choices(vocabulary, k=rng.randint(1, 40)))] + [
            " ".join(rng.choices(vocabulary[: rng.randint(3, 27)], k=30))] * 4)
        rows.append((k, text, rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "é", None, ""]), 1))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_plain_python(spark, seed):
    rows = rows_of(300, seed)
    found = divergence.audit(clashing(spark.createDataFrame(rows, DOCS).repartition(3)))
    assert sorted(map(tuple, found.collect())) == plain(rows)


def test_groups_without_terms_repeats_and_empty_table(spark):
    same = (1, "one two two", "en", "a", 1)
    rows = [same] * 12 + [(2, None, "en", "b", 1), (3, "!!", "en", "c", 1), (4, "rare", "fr", "a", 1), (5, "x", "fr", "b", 1)]
    found = divergence.audit(spark.createDataFrame(rows, DOCS))
    assert sorted(map(tuple, found.collect())) == plain(rows)
    assert divergence.audit(spark.createDataFrame([], DOCS)).count() == 0


def test_very_long_text(spark):
    rows = [(k, "some words", "en", "a", 1) for k in range(10)] + [(99, "some WORDS " * 400_000, "en", "b", 1)]
    df = spark.createDataFrame(rows[:10] + [(99, None, "en", "b", 1)], DOCS).withColumn(
        "text", F.when(F.col("doc_id") == 99, F.expr("repeat('some WORDS ', 400000)")).otherwise(F.col("text")))
    assert sorted(map(tuple, divergence.audit(df).collect())) == plain(rows)


def test_rates_are_exact_for_large_counts():
    rng = random.Random(5)
    for _ in range(500):
        whole = rng.randint(2, 9 * 10**15)
        n = rng.randint(0, whole - 2)
        assert divergence._rates(np.array([n]), whole)[0] == 1 + 10**9 * (n + 2) // whole


def test_cells_of_a_pair_add_up(spark, monkeypatch):
    rows = rows_of(200, 4)
    monkeypatch.setattr(divergence, "CELL_BITS", 3)
    found = divergence.audit(spark.createDataFrame(rows, DOCS), least_docs=2)
    assert sorted(map(tuple, found.collect())) == plain(rows, least=2)
