import random
from collections import defaultdict

from llm_data import words
from pyspark.sql import functions as F

from marketlake.llm import mixing
from marketlake.llm.numbering import with_sums_before
from marketlake.session import materialize


def plain_targets(sizes):
    """Reshare the excess round by round until no source is above three times its size."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**capped, **share}
        capped.update({s: 3 * sizes[s] for s in over})


def corpus(seed, n=400, sources=("b", "a", None, "Z", "é", "c")):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        source = sources[0] if k % 3 == 0 else rng.choice(sources)
        rows.append((k, words(k, rng.choice([0, 1, 5, 30, 80])), source))
    return rows


def test_targets_equal_resharing(spark, make_docs):
    for sources in (("b", "a", None, "Z", "é", "c"), ("x",), ("big", "big", "big", "big", "tiny")):
        rows = corpus(3, 200, sources)
        found = mixing.mix(make_docs(rows)).collect()
        sizes = defaultdict(int)
        for _, t, s in rows:
            sizes[s] += len(t.split())
        expected = plain_targets(dict(sizes))
        source = {k: s for k, _, s in rows}
        for r in found:
            assert abs(r.target - expected[source[r.doc_id]]) < 1e-6
            assert r.source_size == sizes[source[r.doc_id]]


def test_taken_words_come_near_the_target_and_reruns_agree(spark, make_docs):
    rows = corpus(9, 1500)
    docs = make_docs(rows)
    first = {r.doc_id: (r.size, r.taken) for r in mixing.mix(docs).collect()}
    again = {r.doc_id: (r.size, r.taken) for r in mixing.mix(docs.repartition(7, "text")).collect()}
    assert first == again and len(first) == 1500
    source = {k: s for k, _, s in rows}
    taken, biggest = defaultdict(int), max(s for s, _ in first.values())
    for k, (size, n) in first.items():
        assert n in (0, size, 2 * size, 3 * size)
        taken[source[k]] += n
    for r in mixing.targets(mixing.sized_rows(docs)).collect():
        assert abs(taken[r.source] - r.target) <= biggest / 2 + 1e-9


def test_a_larger_budget_takes_a_superset(spark, make_docs):
    rows = [(k, words(k, 10), "hot") for k in range(300)]
    few = [(1000 + k, words(k, 10), "s") for k in range(20)]
    more = [(1000 + k, words(k, 10), "s") for k in range(90)]
    pick = lambda extra: {r.doc_id for r in mixing.mix(make_docs(rows + extra)).collect()
                          if r.doc_id < 1000 and r.taken > 0}
    small, large = sorted((pick(few), pick(more)), key=len)
    assert small <= large and len(small) < len(large)


def test_nulls_repeats_and_extra_columns(spark, make_docs):
    rows = [(None, "a b c", None), (1, None, "s"), (1, None, "s"), (2, "", "s"), (3, "x", "s"), (3, "x", "s")]
    docs = make_docs(rows, extra=True)
    found = mixing.mix(docs).collect()
    assert len(found) == 6 and all(0 <= r.taken <= 3 * r.size for r in found)
    taken = mixing.mixed_documents(docs)
    assert taken.columns == [c for c in docs.columns if c != "mix_copies"] + ["mix_copies"]
    assert taken.agg(F.min("mix_copies")).first()[0] >= 1


def test_empty_table_and_no_words(spark, make_docs):
    assert mixing.mix(make_docs([], extra=True)).count() == 0
    assert [r.taken for r in mixing.mix(make_docs([(1, "", "s"), (2, None, None)])).collect()] == [0, 0]


def test_sums_before_over_many_range_partitions(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(6) / 2, k, rng.randrange(50)) for k in range(60)]
    table = materialize(spark.createDataFrame(rows, "full double, place long, n long"), "rows")
    found = with_sums_before(table, ["full", "place"], ["n"], rows_per_task=7)
    assert found.columns == ["full", "place", "n", "step", "n_before"]
    expected, before = [], 0
    for step, row in enumerate(sorted(rows), 1):
        expected.append((*row, step, before))
        before += row[2]
    assert sorted(tuple(r) for r in found.collect()) == expected


def test_targets_of_many_sources(spark, make_docs):
    sizes = {f"s{k:03d}": (k * 37) % 211 + 1 for k in range(120)}
    docs = make_docs([(k, words(k, n), s) for k, (s, n) in enumerate(sizes.items())])
    expected = plain_targets(sizes)
    found = {r.source: r.target for r in mixing.targets(mixing.sized_rows(docs)).collect()}
    assert found.keys() == expected.keys()
    assert all(abs(found[s] - expected[s]) < 1e-6 for s in sizes)
