import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_data import clashing, words
from pyspark.sql import functions as F

from marketlake.llm import suffix_dedup, suffixes


def plain(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[k: k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d) + 1)
        for k in range(len(d) - length + 1):
            if count[d[k: k + length]] > 1:
                gone[k: k + length] = b"\x01" * length
        spans, at = [], 0
        while (a := gone.find(1, at)) >= 0:
            at = gone.find(0, a)
            spans.append((a, at))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), sum(b - a for a, b in spans), len(spans), spans, hashlib.sha256(kept).hexdigest()))
    return out


def found(df, length=400, **kw):
    rows = suffix_dedup.deduplicate(df, length, **kw).collect()
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_removed, r.n_spans,
                   [tuple(s) for s in r.spans], r.kept_sha256) for r in rows)


def expected(ids, texts, length=400):
    return sorted((i if i is not None else -1, *p) for i, p in zip(ids, plain(texts, length)))


def corpus(seed, n=60):
    """Copies, copies with edits, passages that many texts share, and periodic texts."""
    rng = random.Random(seed)
    base = [words(seed * 100 + k, rng.randint(20, 300)) for k in range(8)]
    passage = words(seed * 100 + 50, 90)
    texts = [None, "", "short", "é" * 399, "é" * 700, "ab" * 500, "x" * 401, "x" * 400, passage]
    for _ in range(n):
        t = rng.choice(base)
        kind = rng.random()
        if kind < 0.3:
            w = t.split(" ")
            for _ in range(rng.randint(1, 3)):
                w[rng.randrange(len(w))] = "édit" + str(rng.randint(0, 9))
            t = " ".join(w)
        elif kind < 0.6:
            t = words(rng.randint(0, 10**9), rng.randint(1, 100)) + passage[rng.randint(0, 80):] + words(rng.randint(0, 9**9), 50)
        elif kind < 0.8:
            t = words(rng.randint(0, 10**9), 120)
        texts.append(t)
    return texts


@pytest.mark.parametrize("seed,shard_bytes", [(1, 1 << 22), (2, 3000), (3, 20_000)])
def test_dedup_equals_brute_force(spark, make_docs, seed, shard_bytes):
    texts = corpus(seed)
    df = make_docs([(k, t, "s") for k, t in enumerate(texts)], extra=True)
    assert found(df, shard_bytes=shard_bytes) == expected(range(len(texts)), texts)


def test_many_shards_of_one_passage(spark, make_docs):
    """The same passage in all documents, each in other surroundings, over many shards."""
    passage = words(7, 80)
    texts = [words(1000 + k, 10) + passage + words(5000 + k, 10 + k % 30) for k in range(80)]
    df = make_docs([(k, t, "s") for k, t in enumerate(texts)])
    assert found(df, shard_bytes=2000) == expected(range(len(texts)), texts)


def test_repeated_rows_null_ids_and_empty_table(spark, make_docs):
    text = words(3, 100)
    rows = [(1, text, "s"), (1, text, "s"), (None, text, "s"), (None, None, "s"), (2, "a", "s"), (2, "a", "s")]
    assert found(make_docs(rows)) == expected([r[0] for r in rows], [r[1] for r in rows])
    assert found(make_docs([])) == []


def test_very_long_text(spark, make_docs):
    long_, part = words(5, 60_000), words(6, 100)
    texts = [long_ + part + long_[:1000], part]
    df = make_docs([(0, None, "s"), (1, part, "s")]).withColumn(
        "text", F.when(F.col("doc_id") == 0, F.lit(texts[0])).otherwise(F.col("text")))
    assert found(df) == expected([0, 1], texts)


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_and_common_prefixes(seed):
    rng = random.Random(seed)
    pieces = [bytes(rng.choices(b"ab" if seed % 2 else b"abcdefgh", k=rng.randint(1, 60))) * rng.randint(1, 5)
              for _ in range(20)] + [b"\x00\x00\xff", b"\xff\x00"]
    data = np.frombuffer(b"".join(pieces), np.uint8)
    ends = np.cumsum([len(p) for p in pieces])
    stop = np.repeat(ends, [len(p) for p in pieces])
    suffix = [bytes(data[k: stop[k]]) for k in range(len(data))]
    whole = suffixes.suffix_array(data, stop, len(data))
    assert whole.tolist() == sorted(range(len(data)), key=lambda k: (suffix[k], k))
    order = suffixes.suffix_array(data, stop, 40)
    assert [suffix[k][:40] for k in order] == [suffix[k][:40] for k in whole]
    shared = suffixes.common_prefixes(data, stop, order, 40)
    for a, b in zip(order[:-1], order[1:]):
        n = 0
        while n < min(len(suffix[a]), len(suffix[b]), 40) and suffix[a][n] == suffix[b][n]:
            n += 1
        assert shared[b] == n


def test_passage_of_over_50_words_below_the_length(spark, make_docs):
    """A repeated passage of 51 words stays where it is shorter than the windows, and goes where it is not."""
    passage = " ".join(f"wo{k:03}" for k in range(51))
    assert len(passage) == 305
    texts = [f"{words(100 + k, 60)} {passage} {words(200 + k, 60)}" for k in range(4)] + [words(300, 120)]
    df = make_docs([(k, t, "s") for k, t in enumerate(texts)])
    assert [r[2] for r in found(df)] == [0] * 5
    assert found(df, 256) == expected(range(5), texts, 256)
    assert [r[2] >= 305 for r in found(df, 256)] == [True] * 4 + [False]
