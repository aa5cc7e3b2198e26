import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import pytest

from marketlake.operators.graph import components, cooccurrence, propagate_labels
from marketlake.operators.terms import extract_terms, merged_terms, trie
from marketlake.session import materialize


def plain_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\t\n\x0b\x0c\r !\"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]", lower) if w]


def plain_components(edges):
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    return {x: top(x) for x in list(root)}


def plain_matches(text, names, depth):
    w, at, out = plain_words(text), 0, []
    while at < len(w):
        size = next((n for n in range(min(depth, len(w) - at), 0, -1) if " ".join(w[at: at + n]) in names), 0)
        if size:
            out.append((at, size, names[" ".join(w[at: at + size])]))
        at += max(size, 1)
    return out


def matches(spark, texts, terms, synonyms, depth):
    names = merged_terms(spark.createDataFrame([(t,) for t in terms], "term string"),
                         spark.createDataFrame(synonyms, "a string, b string"))
    nodes = materialize(trie(names), "trie")
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "id long, text string, words string")
    found = defaultdict(list)
    for r in extract_terms(docs, nodes, depth, "id", "text").collect():
        found[r.id].append((r.start, r.size, r.skill))
    return {k: sorted(v) for k, v in found.items()}


def test_overlaps_nesting_and_synonyms(spark):
    terms = ["machine learning", "learning", "deep machine learning engineer", "machine", "learning rate", "ml", "c", "été fini", "", "!!"]
    synonyms = [("ml", "machine learning"), ("ml", "deep machine learning engineer"), ("été fini", "c")]
    texts = ["Deep machine learning, engineer!", "deep machine learning rate", "machine learning rate", "ML/C; learning",
             None, "", "machine machine learning learning rate", "été FINI", "x y z"]
    names = {"machine learning": "deep machine learning engineer", "ml": "deep machine learning engineer",
             "deep machine learning engineer": "deep machine learning engineer", "learning": "learning",
             "machine": "machine", "learning rate": "learning rate", "c": "c", "été fini": "c"}
    want = {k: m for k, t in enumerate(texts) if (m := plain_matches(t, names, 4))}
    assert matches(spark, texts, terms, synonyms, 4) == want
    assert want[1] == [(1, 2, "deep machine learning engineer")] and want[0][0][1] == 4


def test_extraction_equals_plain_python(spark):
    rng = random.Random(3)
    words = ["a", "b", "c", "d", "e"]
    terms = sorted({" ".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(25)} - {"a"})
    synonyms = [tuple(rng.sample(terms, 2)) for _ in range(8)]
    root = plain_components(synonyms)
    names = {t: root.get(t, t) for t in terms}
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(60)]
    want = {k: m for k, t in enumerate(texts) if (m := plain_matches(t, names, 4))}
    assert matches(spark, texts, terms, synonyms, 4) == want


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(8, 30)] + [(3, 3), (1, 2)]
    edges += [tuple(rng.sample(range(200, 260), 2)) for _ in range(40)]
    found = components(spark.createDataFrame(edges + [(None, 4)], "a long, b long"))
    assert dict(map(tuple, found.collect())) == plain_components(edges)


@pytest.mark.parametrize("share,weight", [(0.2, 1), (0.5, 2), (1.0, 1)])
def test_pairs_equal_brute_force_with_a_term_in_all_groups(spark, share, weight):
    rng = random.Random(11)
    rows = []
    for g in range(120):
        items = {"everywhere"} | {f"i{int(rng.expovariate(0.3))}" for _ in range(rng.randint(0, 8))}
        rows += [(g, i) for i in items] * rng.randint(1, 2)
    rows += [(500, f"i{k}") for k in range(30)] + [(None, "i1"), (3, None)]  # a group of all items
    held = defaultdict(set)
    for g, i in rows:
        if g is not None and i is not None:
            held[i].add(g)
    want = {}
    for a, b in combinations(sorted(held), 2):
        n, union = len(held[a] & held[b]), len(held[a] | held[b])
        if n >= max(weight, 1) and n / union >= share:
            want[a, b] = (n, round(n / union, 9))
    found = cooccurrence(spark.createDataFrame(rows, "g long, i string"), "g", "i", share, weight)
    assert {(r.a, r.b): (r.weight, round(r.share, 9)) for r in found.collect()} == want


def plain_labels(edges, rounds):
    near = defaultdict(list)
    for a, b, w in edges:
        near[a].append((b, w))
        near[b].append((a, w))
    labels, seen = {x: x for x in near}, set()
    seen.add(tuple(sorted(labels.items())))
    for _ in range(rounds):
        new = {}
        for x, around in near.items():
            votes = Counter({labels[x]: max(w for _, w in around)})
            for y, w in around:
                votes[labels[y]] += w
            new[x] = min(votes, key=lambda label: (-votes[label], label))
        labels = new
        if (state := tuple(sorted(labels.items()))) in seen:
            break
        seen.add(state)
    return labels


@pytest.mark.parametrize("seed,rounds", [(1, 50), (2, 50), (3, 2)])
def test_labels_equal_plain_python(spark, seed, rounds):
    rng = random.Random(seed)
    edges = {}
    for _ in range(120):
        c = rng.randrange(5)
        a, b = sorted(rng.sample(range(c * 10, c * 10 + (14 if rng.random() < 0.1 else 10)), 2))
        edges[a, b] = rng.randint(1, 9)
    rows = [(a, b, w) for (a, b), w in edges.items()]
    found = propagate_labels(spark.createDataFrame(rows, "a long, b long, weight long"), rounds)
    assert dict(map(tuple, found.collect())) == plain_labels(rows, rounds)


def test_empty_tables(spark):
    rows = spark.createDataFrame([], "g long, i string")
    edges = cooccurrence(rows, "g", "i", 0.5)
    assert edges.count() == 0 and propagate_labels(edges).count() == 0
    assert matches(spark, ["a b"], [], [], 3) == {}
