"""Small analytical marts over silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators.topk import top_values_per_group


def top_terms(df: DataFrame, group: str, terms: str, k: int = 10) -> DataFrame:
    """The k most frequent non-empty terms of each group; ``terms`` is an array column."""
    exploded = df.select(group, F.explode(terms).alias("term")).filter("term <> ''")
    return top_values_per_group(exploded, group, "term", k)
