"""Salary regression on nested fields, and what each field is worth to it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators.graph import dense_numbers
from marketlake.operators.topk import top_groups
from marketlake.session import materialize

#: Values of a text field that get a number of their own, most frequent first; the others share one.
MOST_VALUES = 100


@dataclass(frozen=True)
class SalaryModel:
    """Boosted trees over numbered fields; ``values`` holds at most ``MOST_VALUES`` a text field."""

    values: dict[str, list[str]]
    numbers: list[str]
    trees: PipelineModel

    @property
    def fields(self) -> list[str]:
        return [*self.values, *self.numbers]

    def encoded(self, df: DataFrame) -> DataFrame:
        """``df`` with every field as a number: the rank of a text, -1 for null, -2 for a null number."""
        out = {}
        for c, known in self.values.items():
            rank = F.lit(float(len(known)))
            if known:
                places = F.create_map(*[F.lit(x) for k, v in enumerate(known) for x in (v, float(k))])
                rank = F.coalesce(F.get(F.array(F.try_element_at(places, F.col(c))), F.lit(0)), rank)
            out[c] = F.when(F.col(c).isNull(), F.lit(-1.0)).otherwise(rank)
        out |= {c: F.coalesce(F.col(c).cast("double"), F.lit(-2.0)) for c in self.numbers}
        return df.withColumns(out)

    def predict(self, encoded: DataFrame) -> DataFrame:
        """Rows of ``encoded`` with ``predicted``."""
        return self.trees.transform(encoded).drop("features").withColumnRenamed("prediction", "predicted")


def train_salary(train: DataFrame, label: str, texts: list[str], numbers: list[str], rounds: int = 10,
                 depth: int = 4) -> SalaryModel:
    """Fit on rows whose label is known; the fields are top-level columns, texts or numbers."""
    known = train.filter(F.col(label).isNotNull())
    values = {c: [r[c] for r in top_groups(known.filter(F.col(c).isNotNull()), [c], MOST_VALUES).collect()] for c in texts}
    bare = SalaryModel(values, numbers, None)
    steps = [VectorAssembler(inputCols=bare.fields, outputCol="features"),
             GBTRegressor(featuresCol="features", labelCol=label, maxIter=rounds, maxDepth=depth, seed=7)]
    rows = materialize(bare.encoded(known).withColumn(label, F.col(label).cast("double")).select(label, *bare.fields), "train")
    return SalaryModel(values, numbers, Pipeline(stages=steps).fit(rows))


def errors(predicted: DataFrame, label: str, mean: Column) -> DataFrame:
    """One row: (row_cnt, model_mse, mean_mse), the model beside always answering ``mean``."""
    own = F.col(label).cast("double")
    return predicted.agg(
        F.count(F.lit(1)).alias("row_cnt"), F.avg((own - F.col("predicted")) ** 2).alias("model_mse"),
        F.avg((own - mean) ** 2).alias("mean_mse"))


def importance(model: SalaryModel, rows: DataFrame, key: str, label: str, repeats: int = 2) -> DataFrame:
    """(field, repeat, mse, added_mse): the error after one field is taken from other rows.

    Rows are numbered once; in a repeat a field comes from the row a fixed number of places
    on, a different one for every field and repeat, so each value is used once.  All fields
    and repeats, and the untouched rows, are scored by one job: the rows once for each.
    ``rows`` have a unique key and a known label.
    """
    plain = model.encoded(rows.filter(F.col(label).isNotNull())).select(
        F.col(key).alias("group"), F.col(label).cast("double").alias("own"), *model.fields)
    numbered = materialize(plain.join(dense_numbers(plain), "group"), "numbered")
    total = numbered.count()
    if not total:
        return rows.sparkSession.createDataFrame([], "field string, repeat int, mse double, added_mse double")
    plans = [F.struct(F.lit(None).cast("string").alias("field"), F.lit(0).alias("repeat"), F.lit(0).alias("shift"))]
    plans += [F.struct(F.lit(c).alias("field"), F.lit(r).alias("repeat"), F.lit(shift(total, k, r)).alias("shift"))
              for k, c in enumerate(model.fields) for r in range(repeats)]
    tried = numbered.select("*", F.inline(F.array(*plans))).withColumn("from", (F.col("number") + F.col("shift")) % total)
    donors = numbered.select(F.col("number").alias("from"), *[F.col(c).alias(f"other_{c}") for c in model.fields])
    taken = tried.join(donors, "from").withColumns(
        {c: F.when(F.col("field") == c, F.col(f"other_{c}")).otherwise(F.col(c)) for c in model.fields})
    scored = model.predict(taken).groupBy("field", "repeat").agg(
        F.avg((F.col("own") - F.col("predicted")) ** 2).alias("mse"))
    scored = materialize(scored, "importance")
    base = scored.filter("field is null").select(F.col("mse").alias("base"))
    return scored.filter("field is not null").crossJoin(F.broadcast(base)).select(
        "field", "repeat", "mse", (F.col("mse") - F.col("base")).alias("added_mse"))


def shift(total: int, field: int, repeat: int) -> int:
    """Places between a row and the one it takes a field from; never 0 where there are two rows."""
    return 1 + (7919 * (field + 1) + 104_729 * repeat) % max(total - 1, 1)
