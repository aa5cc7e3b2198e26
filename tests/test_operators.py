"""Quantiles, de-duplication, facets, trees and reports on small frames."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from marketlake.operators.dedup import (
    distinct_rows_of_top_key,
    duplicate_share,
    publication_counts,
    repeated_rows,
    with_publication_count,
)
from marketlake.operators.facets import facet_counts
from marketlake.operators.profile import list_length_stats, null_and_empty_report
from marketlake.operators.quality import null_rate_history
from marketlake.operators.quantiles import exact_quantiles
from marketlake.operators.topk import first_n_per_group, random_rows, stable_sample
from marketlake.operators.tree import child_counts, walk_tree
from marketlake.sources.tables import object_store_conf

PROBS = [0.0, 0.25, 0.5, 0.75, 0.95, 1.0]


@pytest.mark.parametrize("method", ["linear", "nearest"])
def test_exact_quantiles(spark, method):
    rnd = random.Random(1)
    a = [rnd.gauss(0, 1) * 10 ** rnd.randint(-6, 9) for _ in range(997)]
    b = [5.0] * 600 + [float(rnd.randint(-3, 3)) for _ in range(397)]
    df = spark.createDataFrame(list(zip(a, b)) + [(None, None)], "a double, b double")
    got = {(r["column"], r["prob"]): r["value"]
           for r in exact_quantiles(df, ["a", "b"], PROBS, method).collect()}
    for name, values in (("a", sorted(a)), ("b", sorted(b))):
        for p in PROBS:
            if method == "linear":
                want = np.quantile(values, p)
            else:
                want = values[int(p * (len(values) - 1) + 0.5)]
            assert got[(name, p)] == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_quantiles_of_big_numbers_and_signs(spark):
    values = [float("inf"), -1e308, 1e308, 0.0, -0.0, 1e-300, -1e-300]
    df = spark.createDataFrame([(v,) for v in values], "a double")
    got = [r["value"] for r in exact_quantiles(df, ["a"], [0.0, 0.5, 1.0], "nearest")
           .orderBy("prob").collect()]
    assert got == [-1e308, 0.0, float("inf")]


def test_quantiles_keep_every_digit_and_rank_nan_last(spark):
    big = 2**53
    ints = spark.createDataFrame([(big + 1,), (big + 3,), (big + 5,), (None,)], "a long")
    got = exact_quantiles(ints, ["a"], [0.5], "linear").first()
    assert int(got["exact"]) == big + 3 and exact_quantiles(ints, ["a"], [1.0], "nearest").first()["exact"] == big + 5
    decimals = spark.sql("select cast(x as decimal(30,4)) as a from values ('12345678901234567890.0001'), "
                         "('12345678901234567890.0002'), ('12345678901234567890.0009') as t(x)")
    assert str(exact_quantiles(decimals, ["a"], [0.5]).first()["exact"]) == "12345678901234567890.000200"
    odd = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),)], "a double")
    values = [r["value"] for r in exact_quantiles(odd, ["a"], [0.0, 0.5, 1.0], "nearest").orderBy("prob").collect()]
    assert values[:2] == [1.0, 2.0] and values[2] != values[2]


def test_list_length_stats(spark):
    lens = [0, 0, 1, 2, 2, 3, 9]
    df = spark.createDataFrame([(list(range(n)),) for n in lens] + [(None,)], "v array<int>")
    got = list_length_stats(df, "v").first()
    near = [lens[int(q * (len(lens) - 1) + 0.5)] for q in (0.25, 0.75, 0.95)]
    assert tuple(got) == (0, 9, round(17 / 7, 6), 2.0, *near)


@pytest.mark.parametrize("hot", [0, 2, 100])
def test_null_keys_are_a_group(spark, hot):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (None, "d"), (None, "e"), (2, "f")], "k int, v string")
    assert {r["v"] for r in repeated_rows(df, ["k"], hot).collect()} == set("abcde")
    assert rows(with_publication_count(df, "k", hot).select("v", "publication_cnt")) == [
        ("a", 3), ("b", 3), ("c", 3), ("d", 2), ("e", 2), ("f", 1)]
    share = duplicate_share(df.withColumn("d", F.lit(1)), "k", ["d"]).first()
    assert tuple(share) == (1, 4, 2, 50.0)


def test_copies_of_top_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "x")], "k int, v string")
    assert rows(distinct_rows_of_top_key(df, ["k"])) == [(1, 3, 2)]


def test_publication_counts(spark):
    df = spark.sql("select * from values (1, date'2024-01-01'), (1, date'2024-01-01'), "
                   "(1, date'2024-01-03'), (2, date'2024-01-02') as t(k, d)")
    got = {r["k"]: (r["publication_cnt"], r["day_cnt"]) for r in
           publication_counts(df, "k", F.col("d")).collect()}
    assert got == {1: (3, 2), 2: (1, 1)}


def test_first_n_per_group_of_a_hot_group(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)).alias("g"),
        (F.col("id") * 7919 % 5003).alias("o"))
    got = first_n_per_group(df, ["g"], 10, [F.col("o")], F.col("o"), salts=8)
    hot = [r["o"] for r in got.filter("g = -1").orderBy("o").collect()]
    want = sorted(i * 7919 % 5003 for i in range(5000) if i % 3)[:10]
    assert hot == want


def test_facets_of_lists_and_nulls(spark):
    df = spark.createDataFrame([("x", ["p", "q"]), (None, ["p"]), ("x", []), ("y", None)],
                               "a string, l array<string>")
    got = {(r["facet"], r["value"]): r["found"] for r in
           facet_counts(df, {"a": F.col("a")}, {"l": F.col("l")}).collect()}
    assert got == {("a", "x"): 2, ("a", None): 1, ("a", "y"): 1,
                   ("l", "p"): 2, ("l", "q"): 1, ("l", None): 1}


def nodes(spark, depth):
    data = [("0", None, "n0")] + [(str(i), str(i - 1), f"n{i}") for i in range(1, depth + 1)]
    return spark.createDataFrame(data, "id string, parent_id string, name string")


def test_tree_walk_goes_as_deep_as_the_tree(spark):
    got = walk_tree(nodes(spark, 12)).orderBy("level").collect()
    assert [r["level"] for r in got] == list(range(13))
    assert got[3]["path"] == "n0 / n1 / n2 / n3"
    assert {r["id"]: r["child_cnt"] for r in child_counts(nodes(spark, 2)).collect()} == {
        "0": 1, "1": 1, "2": 0}


def test_tree_without_roots_or_with_a_ring(spark):
    schema = "id string, parent_id string, name string"
    assert walk_tree(spark.createDataFrame([], schema)).count() == 0
    ring = spark.createDataFrame([("r", None, "r"), ("a", "b", "a"), ("b", "a", "b")], schema)
    assert [r["id"] for r in walk_tree(ring).collect()] == ["r"]


def test_samples_have_the_asked_size(spark):
    df = spark.range(100)
    assert random_rows(df, 7, 1).count() == 7
    assert rows(stable_sample(df, 7, F.col("id"))) == rows(
        stable_sample(df.repartition(3), 7, F.col("id")))


def test_null_and_empty_report(spark):
    df = spark.createDataFrame([(1, [1]), (None, []), (2, None), (3, [])], "a int, l array<int>")
    got = {r["column"]: (r["null_cnt"], r["null_pcnt"], r["empty_list_cnt"], r["empty_pcnt"])
           for r in null_and_empty_report(df).collect()}
    assert got == {"a": (1, 25.0, None, None), "l": (1, 25.0, 2, 50.0)}


def test_null_rate_history_flags_a_vanished_column(spark):
    df = spark.sql("select * from values (date'2024-01-01', 1), (date'2024-01-02', 1), "
                   "(date'2024-01-03', null) as t(d, v)")
    got = {str(r["day"]): (r["null_rate"], r["drifted"]) for r in
           null_rate_history(df, ["v"], F.col("d"), 0.5).collect()}
    assert got == {"2024-01-01": (0.0, False), "2024-01-02": (0.0, False), "2024-01-03": (1.0, True)}


def test_object_store_options_hold_only_what_the_caller_gave():
    conf = object_store_conf("http://store:9000", "k", "s")
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
