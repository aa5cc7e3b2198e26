"""Train, score and judge a classifier on the labelled vectors."""

from pyspark.sql import functions as F

from marketlake.catalog.base import query, table
from marketlake.plans.model import accuracy, fit_classifier, hash_split, score, with_features


def _data(spark, sf):
    return hash_split(with_features(table(spark, sf, "embeddings"), F.col("embedding")), F.col("vec_id"))


def _model(spark, sf):
    return fit_classifier(_data(spark, sf).filter(~F.col("is_test")), "label")


def _scored(spark, sf):
    return score(_model(spark, sf), _data(spark, sf).filter("is_test"), "label")


@query("m1_split", """select vec_id, ('0x' || substr(md5(vec_id::varchar), 1, 7))::bigint % 100 < 20 as is_test
from embeddings""")
def m1(spark, sf):
    return _data(spark, sf).select("vec_id", "is_test")


@query("m2_train")
def m2(spark, sf):
    scored = score(_model(spark, sf), _data(spark, sf).filter(~F.col("is_test")), "label")
    return accuracy(scored)


@query("m3_score")
def m3(spark, sf):
    return _scored(spark, sf).select("vec_id", "actual_class", "predicted_class")


@query("m4_accuracy")
def m4(spark, sf):
    return accuracy(_scored(spark, sf))


_TEST = "('0x' || substr(md5(vec_id::varchar), 1, 7))::bigint % 100 < 20"


@query("m4_better_than_majority", f"""select (select count(*) from embeddings where {_TEST}) as row_cnt, true as scored_all,
  true as better""")
def m4_better(spark, sf):
    """Whether the classifier beats always answering the most frequent class of the test rows."""
    scored = _scored(spark, sf)
    by_class = scored.groupBy("actual_class").agg(
        F.count(F.lit(1)).alias("n"), F.count("predicted_class").alias("scored"),
        F.count_if(F.col("actual_class") == F.col("predicted_class")).alias("hits"))
    return by_class.agg(
        F.sum("n").alias("row_cnt"), (F.sum("n") == F.sum("scored")).alias("scored_all"),
        (F.sum("hits") > F.max("n")).alias("better"))
