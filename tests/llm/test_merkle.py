import hashlib
import random
import zlib

import pytest
from llm_data import clashing
from pyspark.sql import functions as F

from marketlake.llm import merkle

DOCS = "doc_id long, source string, lang string, n_chars long, text string"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def rise(nodes, at):
    """(root, siblings of child ``at`` upwards, root with ``at`` folded by ``with_``) of one row."""
    siblings = []
    while len(nodes) > 1:
        run = nodes[at // 2 * 2: at // 2 * 2 + 2]
        siblings.append((at % 2, [n for k, n in enumerate(run) if k != at % 2]))
        nodes = [h(*nodes[k: k + 2]) for k in range(0, len(nodes), 2)]
        at //= 2
    return nodes[0], siblings


def fold(node, siblings):
    for side, others in siblings:
        node = h(*others, node) if side else h(node, *others)
    return node


def plain(rows):
    lots = {}
    for r in rows:
        lots.setdefault(r[2], []).append(r)
    order = sorted(lots, key=lambda x: (x is not None, (x or "").encode()))
    for v in lots.values():
        v.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    subroots = [rise([leaf(r) for r in lots[x]], 0)[0] for x in order]
    out = []
    for k, x in enumerate(order):
        leaves = [leaf(r) for r in lots[x]]
        root, above = rise(subroots, k)
        for at, r in enumerate(lots[x]):
            steps = rise(leaves, at)[1] + above
            hit = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            given = leaf((*r[:3], r[3] + 1, r[4])) if hit else leaf(r)
            folded = fold(given, steps)
            out.append((r[0], leaf(r), subroots[k], root, h(*[n for _, s in steps for n in s]), folded, folded == root))
    return sorted(out, key=repr)


def rows_of(sizes, seed=1):
    rng = random.Random(seed)
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            i += rng.randint(1, 3)
            text = rng.choice([None, "", "é\x00ü", "word " * rng.randint(1, 50)])
            rows.append((i, rng.choice([None, "s", "http"]), lang, None if rng.random() < 0.2 else rng.randint(0, 99), text))
    rng.shuffle(rows)
    return rows


def run(df):
    given = merkle.tampered_leaf(df, FIELDS, changed="n_chars", key="doc_id")
    return merkle.manifest(df, FIELDS, group="lang", key="doc_id", given=given)


@pytest.mark.parametrize("sizes", [
    {"en": 1}, {None: 1, "de": 2}, {"en": 5, None: 3, "": 1, "ä": 6, "z": 8}, {"en": 2500, "de": 1024, None: 1025},
    {f"l{k}": 1 + k % 3 for k in range(1100)},
])
def test_manifest_equals_plain_trees(spark, sizes):
    rows = rows_of(sizes)
    found = run(clashing(spark.createDataFrame(rows, DOCS).repartition(3)))
    assert sorted(map(tuple, found.collect()), key=repr) == plain(rows)


def test_nulls_repeats_and_empty_table(spark):
    rows = [(None, None, None, None, None)] * 3 + [(7, "s", "en", 3, "abc")] * 5 + [(7, "s", "en", 4, "abcd"), (None, "s", "en", 1, "x")]
    assert sorted(map(tuple, run(spark.createDataFrame(rows, DOCS)).collect()), key=repr) == plain(rows)
    assert run(spark.createDataFrame([], DOCS)).count() == 0


def test_full_proofs_lead_to_the_root(spark):
    rows = rows_of({"en": 70, "de": 9})
    out = merkle.manifest(spark.createDataFrame(rows, DOCS), FIELDS, "lang", "doc_id", full_proofs=True)
    for r in out.collect():
        steps = [(p[0] == "L", [p[1:]] if p != "-" else []) for p in r.proof]
        assert r.verified and fold(r.leaf, steps) == r.root
        assert h(*[n for _, s in steps for n in s]) == r.proof_sha256


def test_very_long_text(spark):
    rows = [(1, "s", "en", 1, "long é " * 1_000_000), (2, "s", "en", 2, "x")]
    df = spark.createDataFrame([(1,), (2,)], "doc_id long").select(
        "doc_id", F.lit("s").alias("source"), F.lit("en").alias("lang"), F.col("doc_id").alias("n_chars"),
        F.when(F.col("doc_id") == 1, F.expr("repeat('long é ', 1000000)")).otherwise("x").alias("text"))
    assert sorted(map(tuple, run(df).collect()), key=repr) == plain(rows)
