"""Delimited text dumps read as strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F


def _reader(spark: SparkSession, sep: str, multiline: bool) -> DataFrameReader:
    return (
        spark.read.option("sep", sep)
        .option("header", "true")
        .option("inferSchema", "false")
        .option("mode", "PERMISSIVE")
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("multiLine", str(multiline).lower())
    )


def files_with_line_breaks(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Files in which a quoted field goes on in the next line: some line has an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = spark.read.text(path).filter(quotes % 2 == 1).select(F.col("_metadata.file_path").alias("file"))
    return [r["file"] for r in odd.distinct().collect()]


def scan_dump(
    spark: SparkSession, path: str | list[str], sep: str = ",", multiline: bool | None = None
) -> DataFrame:
    """A delimited dump with a header, every column STRING, bad rows tolerated.

    Undecodable bytes become U+FFFD, short rows are padded with NULL, extra columns
    are dropped, an empty field is NULL and a quoted empty one is ''.  Quoted fields
    may hold line breaks: by default one distributed pass over the lines finds the files
    that have them, and each of these is read in one task, while Spark splits the others.
    ``multiline`` says it of all files and saves the pass.
    """
    if multiline is not None:
        return _reader(spark, sep, multiline).csv(path)
    broken = files_with_line_breaks(spark, path)
    if not broken:
        return _reader(spark, sep, False).csv(path)
    # One header for both parts, read so that it may have a line break itself.
    quoted = _reader(spark, sep, True).csv(path)
    in_broken = F.col("_metadata.file_path").isin(broken)
    plain = _reader(spark, sep, False).schema(quoted.schema).csv(path)
    return plain.filter(~in_broken).unionByName(quoted.filter(in_broken))
