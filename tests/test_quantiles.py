"""Numbers that lie close together: most values reach the last ranks, in ranges of bounded size."""

import random

import pytest
from marketlake.operators import quantiles


@pytest.mark.parametrize("method", ["linear", "nearest"])
def test_close_values_are_ranked_in_ranges(spark, monkeypatch, method):
    monkeypatch.setattr(quantiles, "VALUES_PER_TASK", 100, raising=False)
    tables, plain = {}, quantiles.materialize

    def kept(df, label):
        tables[label] = plain(df, label)
        return tables[label]

    monkeypatch.setattr(quantiles, "materialize", kept)
    rnd = random.Random(3)
    base = 9007199254740993
    values = [base + rnd.randrange(100_000) for _ in range(1500)] + [base + 7] * 500 + [None] * 9
    rnd.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "a long")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r["prob"]: r["exact"] for r in quantiles.exact_quantiles(df, ["a"], probs, method).collect()}
    known = sorted(v for v in values if v is not None)
    for p in probs:
        at = p * (len(known) - 1)
        if method == "nearest":
            assert got[p] == known[int(at + 0.5)]
        else:
            low, high = known[int(at)], known[min(int(at) + 1, len(known) - 1)]
            assert abs(float(got[p] - low) - (high - low) * (at - int(at))) < 1e-3
    sizes = [r["count"] for r in tables["quantile_values"].groupBy("part").count().collect()]
    assert sum(sizes) == len(set(known)) and len(sizes) > 10 and max(sizes) < 400
