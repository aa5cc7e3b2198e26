import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.operators.vectors import Index, exact_neighbours, fit_index, neighbours, probe_order, recall
from marketlake.plans.roles import report, threshold, vote, with_role

SCHEMA = "id long, v array<float>, extra string"


def plain(rows, queries, k, dim):
    def unit(v):
        if v is None or len(v) != dim or any(x is None or x != x for x in v) or not any(v):
            return None
        x = np.array(v, np.float32).astype(float)
        return x / np.linalg.norm(x)

    held = [(i, u) for i, v, *_ in rows if i is not None and (u := unit(v)) is not None]
    out = []
    for q, v, *_ in queries:
        u = unit(v)
        if q is None or u is None:
            continue
        near = sorted((-round(float(u @ w), 10), i) for i, w in held if i != q)[:k]
        out += [(q, r, i, round(-s, 8)) for r, (s, i) in enumerate(near, 1)]
    return sorted(out)


def rounded(df):
    return sorted((r.query, r.rank, r.neighbour, round(r.similarity, 8)) for r in df.collect())


def make(seed, n, dim=8, clusters=6):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((clusters, dim)) * 3
    return [(k, [float(np.float32(x)) for x in centres[k % clusters] + rng.standard_normal(dim)], "x") for k in range(n)]


def test_exact_equals_brute_force_with_odd_rows(spark):
    rows = make(1, 300) + [(1000, None, "x"), (1001, [0.0] * 8, "x"), (1002, [1.0] * 7, "x"), (None, [1.0] * 8, "x"),
                           (1003, [1.0, None, *[2.0] * 6], "x"), (1004, [float("nan")] * 8, "x")]
    rows += [(2000 + k, rows[5][1], "x") for k in range(40)]  # ties: equal vectors
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    asked = [r for r in rows if r[0] is not None and (r[0] % 10 == 0 or r[0] >= 1000)]
    queries = spark.createDataFrame(asked, SCHEMA)
    want = plain(rows, asked, 10, 8)
    assert rounded(exact_neighbours(df, queries, "id", "v", 10)) == want
    assert rounded(exact_neighbours(df, queries, "id", "v", 10, block=7)) == want


def test_probing_everything_is_exact_in_split_buckets(spark):
    rows = make(2, 400)
    rows += [(5000 + k, rows[3][1], "x") for k in range(150)]  # one crowded bucket, of rows and of queries
    df = spark.createDataFrame(rows, SCHEMA)
    asked = df.filter("id % 5 = 0")
    index = Index(np.random.default_rng(3).standard_normal((2, 8, 3)), probe_order(3, 100))
    assert len(index.probes) == 8
    truth = exact_neighbours(df, asked, "id", "v", 10)
    for bucket_rows in (20_000, 30):
        assert rounded(neighbours(df, asked, index, "id", "v", 10, bucket_rows)) == rounded(truth)


def test_fitted_index_reaches_its_recall(spark):
    rows = make(4, 3000, dim=16, clusters=40)
    df = spark.createDataFrame(rows, SCHEMA)
    asked = df.filter("id % 10 = 0")
    index = fit_index(df, asked, "id", "v", 10)
    found = recall(neighbours(df, asked, index, "id", "v", 10), exact_neighbours(df, asked, "id", "v", 10)).first()
    assert found.query_cnt == 300 and found.recall >= 0.9
    # On data with clusters a query looks at a part of the codes only.
    assert len(index.probes) < 1 << index.bits


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame(make(1, 3), SCHEMA)
    assert exact_neighbours(df, df, "id", "v").count() == 0
    assert exact_neighbours(one, df, "id", "v").count() == 0
    assert neighbours(one, df, fit_index(one, df, "id", "v"), "id", "v").count() == 0


def test_probe_order_lists_every_set_once():
    probes = probe_order(6, 1000)
    assert len({tuple(p) for p in probes.tolist()}) == 64 and not probes[0].any()
    assert probes[1].tolist() == [True] + [False] * 5


@pytest.mark.parametrize("precision", [0.3, 0.6, 0.99])
def test_open_set_vote(spark, precision):
    rng = random.Random(7)
    labels = [(k, rng.choice([0, 1, 2, None])) for k in range(200)]
    near = [(q, r, rng.randrange(200), round(rng.random(), 2)) for q in range(200, 260) for r in range(1, 6)]
    own = labels + [(q, rng.randint(0, 2)) for q in range(200, 260)]
    known = spark.createDataFrame(labels, "id long, label int")
    voted = vote(spark.createDataFrame(near, "query long, rank int, neighbour long, similarity double"), known, "id", "label")
    of = dict(labels)
    want = {}
    for q in range(200, 260):
        got = [(of[i], s) for a, _, i, s in near if a == q and of[i] is not None]
        if got:
            count = Counter(x for x, _ in got)
            best = min(count, key=lambda x: (-count[x], x))
            want[q] = (best, count[best], len(got), round(max(s for _, s in got), 4))
    assert {r.query: tuple(r)[1:] for r in voted.collect()} == want
    all_own = spark.createDataFrame(own, "id long, label int")
    least = threshold(voted.filter("query < 230"), all_own, "id", "label", precision)
    held = [(s, best == dict(own)[q]) for q, (best, _, _, s) in want.items() if q < 230]
    fits = [t for t, _ in held if sum(ok for s, ok in held if s >= t) >= precision * sum(s >= t for s, _ in held)]
    assert least.first()[0] == (min(fits) if fits else None)
    roles = with_role(voted.filter("query >= 230"), least)
    sure = {q for q, x in want.items() if q >= 230 and fits and x[3] >= min(fits)}
    assert {r.query for r in roles.collect() if r.role is not None} == sure
    total = report(roles, all_own, "id", "label").first()
    right = sum(want[q][0] == dict(own)[q] for q in sure)
    assert (total.unknown_cnt, total.right_cnt, total.wrong_cnt) == (total.row_cnt - len(sure), right, len(sure) - right)
