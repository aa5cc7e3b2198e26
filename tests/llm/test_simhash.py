import random
import re

import numpy as np
import pytest
import xxhash
from llm_data import clashing, words
from pyspark.sql import functions as F

from marketlake.llm import simhash
from marketlake.llm.components import connected

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_print(value, n=3):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), value or ""))
    shingles = [" ".join(w[k:k + n]) for k in range(len(w) - n + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bound=2):
    """{id: smallest id reachable} over all pairs."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if bin(prints[a] ^ prints[b]).count("1") <= bound:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: top(i) for i in ids}


def test_fingerprints_equal_plain_python(spark, make_docs):
    texts = ["", None, "One", "one TWO", words(1, 300), "É é É é  x\ty\nz", "a b c " * 40, "   \n"]
    found = simhash.fingerprints(make_docs([(k, t, "s") for k, t in enumerate(texts)], extra=True))
    got = {r.doc_id: r.hex for r in found.withColumn("hex", simhash.to_hex(F.col("bits"))).collect()}
    assert got == {k: f"{plain_print(t):016x}" for k, t in enumerate(texts)}


@pytest.mark.parametrize("width", [2, 4, 8])
def test_popcounts(spark, width):
    rng = random.Random(width)
    values = [0, -1, 1 << 62, -(1 << 63), *[rng.getrandbits(64) - (1 << 63) for _ in range(50)]]
    df = spark.createDataFrame([(v,) for v in values], "bits long")
    for v, e in df.select("bits", simhash.popcounts(F.col("bits"), width)).collect():
        for s in range(64 // width):
            field = (1 << width) - 1
            assert (e >> s * width) & field == bin((v >> s * width) & field).count("1")


@pytest.mark.parametrize("bound,width", [(2, 4), (2, 2), (2, 8), (1, 4), (0, 4)])
def test_components_equal_all_pairs(spark, bound, width):
    rng = random.Random(bound * 10 + width)
    values = [rng.getrandbits(64) for _ in range(15)] + [0, (1 << 64) - 1]
    for _ in range(80):
        v = rng.choice(values)
        for b in rng.sample(range(64), rng.choice([0, 1, 1, 2, 3])):
            v ^= 1 << b
        values.append(v)
    prints = dict(enumerate(values))
    rows = [(k, v - (1 << 64) if v >> 63 else v) for k, v in prints.items()]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, bits long"), bound, width)
    assert {r.doc_id: r.component_id for r in found.collect()} == plain_components(prints, bound)


def test_chain_is_one_component(spark):
    chain = [(k + 1, k) for k in range(60)] + [(100, 101), (102, 101)]
    found = connected(spark.createDataFrame(chain, "a long, b long"))
    got = {r.node: r.root for r in found.collect()}
    assert got == {**{k: 0 for k in range(1, 61)}, 101: 100, 102: 100}


def test_keep_one_row_of_each_group(spark, make_docs):
    a, b = words(1, 120), words(2, 120)
    rows = [(5, a, "s"), (3, a, "t"), (3, a, "t"), (None, a, "s"), (7, b, "s"), (9, "", "s"), (8, None, "s"),
            (None, words(4, 50), "s"), (None, words(4, 50), "s")]
    docs = make_docs(rows, extra=True)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(3, a), (7, b), (8, None), (None, words(4, 50))], key=repr)


def test_empty_table(spark, make_docs):
    empty = make_docs([])
    assert simhash.near_duplicates(simhash.fingerprints(empty)).count() == 0
    assert simhash.keep_one(clashing(empty)).count() == 0


def test_bound_is_checked(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "bits long"), max_bits=3)


def test_long_text(spark, make_docs):
    long = words(8, 30_000)
    found = simhash.fingerprints(make_docs([(1, long, "s")])).first()
    assert np.uint64(found.bits & (1 << 64) - 1) == np.uint64(plain_print(long))
