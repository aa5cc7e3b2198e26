import datetime as dt

from pyspark.sql import functions as F

from marketlake.operators.sketches import daily_sketches, distinct_in_ranges


def test_ranges_are_unions_of_days(spark):
    start = dt.date(2024, 1, 1)
    df = spark.range(60_000).select(
        F.date_add(F.lit(start), (F.col("id") % 20).cast("int")).alias("d"), (F.col("id") % 30_000).alias("v"))
    df = df.unionByName(spark.createDataFrame([(start, None), (None, 5)], "d date, v long"))
    sketches = daily_sketches(df, F.col("d"), "v")
    ranges = [(start, start), (start, dt.date(2024, 1, 20)), (dt.date(2024, 1, 5), dt.date(2024, 1, 11)),
              (dt.date(2025, 1, 1), dt.date(2025, 1, 2))]
    found = {(r.first_day, r.last_day): r.estimate for r in distinct_in_ranges(
        sketches, spark.createDataFrame(ranges, "first_day date, last_day date")).collect()}
    for a, b in ranges:
        exact = df.filter(F.col("d").between(a, b)).agg(F.count_distinct("v")).first()[0]
        assert abs(found[a, b] - exact) <= 0.05 * exact, (a, b, found[a, b], exact)
    assert found[ranges[3]] == 0
