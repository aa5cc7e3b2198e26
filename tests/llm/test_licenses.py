import random
import re

import pytest
from llm_data import words

from marketlake.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(value):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), value or ""))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        at = [k for k in range(len(w)) if w[k:k + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def test_base_equals_plain_python(spark, make_docs):
    rng = random.Random(2)
    pieces = ["CC BY", "cc  by", "cc, by", "ccby", "by cc", "All rights reserved.", "all RIGHTS", "reserved",
              "General Public\nLicense", "general public", "license", "é", "cc", "by", "É", "x9", "\x7f", "`"]
    texts = [" ".join(rng.choice(pieces) for _ in range(rng.randint(0, 25))) for _ in range(150)]
    texts += [None, "", words(1, 30_000) + " cc by", "cc by " * 500]
    docs = make_docs([(k, t, "s") for k, t in enumerate(texts)], extra=True)
    found = licenses.scan(docs, licenses.build_index(docs)).collect()
    assert len(found) == len(texts)
    for r in found:
        assert tuple(r)[1:6] == plain(texts[r.doc_id]), texts[r.doc_id]
        assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))


def test_templates_need_their_key_phrase_and_half_their_weight(spark, make_docs):
    filler = words(3, 40)
    texts = {
        1: filler + "\nLicensed under the Apache License, Version 2.0.\n" + filler,
        2: filler + " apache version 2 0 licensed under " + filler,
        3: "Permission is hereby granted, free of charge, to any person obtaining a copy of THIS software",
        4: "permission granted hereby is free of charge to any person obtaining a copy of this software",
        5: "Licensed under CC BY-NC 4.0.", 6: "This work is licensed under the GNU General Public License, version 3.",
        7: filler,
    }
    docs = make_docs([(k, t, "s") for k, t in texts.items()])
    found = {r.doc_id: (r.labels, r.score) for r in licenses.scan(docs, licenses.build_index(docs)).collect()}
    assert {k: v[0] for k, v in found.items()} == {
        1: "apache-2.0", 2: "", 3: "mit", 4: "", 5: "cc-by,cc-by-nc", 6: "gpl,gpl-3.0", 7: ""}
    assert found[1][1] > 0.99 and found[7][1] == 0


def test_rows_repeat_and_tables_may_be_empty(spark, make_docs):
    docs = make_docs([(1, "cc by", "s"), (1, "cc by", "s"), (None, "cc by", "s")])
    assert [r.n_base for r in licenses.scan(docs, licenses.build_index(docs)).collect()] == [1, 1, 1]
    empty = make_docs([])
    assert licenses.scan(empty, licenses.build_index(empty)).count() == 0


def plain_labels(text, weights):
    """(labels, score) by trying every notice at every place."""
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    labels, best = set(), 0.0
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        if any(w[k: k + len(p)] == p for k in range(len(w))):
            labels.add(label)
            best = 1.0
    for label, notice, key in licenses.TEMPLATES:
        t, p = notice.split(), key.split()
        at = next(k for k in range(len(t)) if t[k: k + len(p)] == p)
        for start in range(-len(t), len(w)):
            if start + at >= 0 and w[start + at: start + at + len(p)] == p:
                there = sum(weights[x] for k, x in enumerate(t) if 0 <= start + k < len(w) and w[start + k] == x)
                share = there / sum(weights[x] for x in t)
                if share >= licenses.LEAST_SHARE:
                    labels.add(label)
                    best = max(best, min(share, 1.0))
    return ",".join(sorted(labels)), best


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_labels_and_score_equal_a_scan_of_every_place(spark, make_docs, seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(150):
        w = rng.choices(licenses.vocabulary() + ["other", "words", "here"], k=rng.randint(0, 12))
        for _ in range(rng.randint(0, 2)):
            t = rng.choice(licenses.TEMPLATES)[1].split()
            for _ in range(rng.randint(0, len(t) // 2)):
                t[rng.randrange(len(t))] = rng.choice(["x", "the", "license"])
            w += t[rng.randint(0, 2):]
        texts.append(" ".join(w))
    # A notice whose rarest words were all changed, in a corpus where they are frequent elsewhere.
    texts += ["licensed under the apache license version 2 0"] * 40 + ["available by the apache license version 2 0"] * 10
    docs = make_docs([(k, t, "s") for k, t in enumerate(texts)])
    index = licenses.build_index(docs)
    for r in licenses.scan(docs, index).collect():
        labels, score = plain_labels(texts[r.doc_id], index.weights)
        assert (r.labels, round(r.score, 9)) == (labels, round(score, 9)), texts[r.doc_id]
