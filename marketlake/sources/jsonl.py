"""JSON-lines scans: declared schema, inferred schema, tolerant scan with quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.casts import try_cast_leaves
from marketlake.sources.contract import VACANCY, as_text, lost_in_cast

BAD_RECORD = "_bad_record"


def scan_jsonl(spark: SparkSession, path: str, schema: T.StructType = VACANCY) -> DataFrame:
    """Scan JSON lines (plain or gz) against ``schema``; errors never fail the job.

    A broken line becomes an all-NULL row, a field that does not fit its type
    becomes NULL, unknown keys are dropped and absent keys are NULL.  The text-leaf
    schema goes straight to the JSON reader, so each line is parsed once and only
    the columns a query uses are parsed.
    """
    raw = (
        spark.read.schema(_reader_schema(schema))
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_RECORD)
        .json(path)
    )
    return conform(raw, schema)


def scan_jsonl_stream(
    spark: SparkSession, path: str, schema: T.StructType = VACANCY, max_files: int = 1000
) -> DataFrame:
    """The same scan over a folder that keeps receiving files."""
    raw = (
        spark.readStream.schema(_reader_schema(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_RECORD)
        .option("maxFilesPerTrigger", max_files)
        .option("recursiveFileLookup", "true")
        .json(path)
    )
    return conform(raw, schema)


def _reader_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*as_text(schema), T.StructField(BAD_RECORD, T.StringType())])


def conform(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast text leaves to the contract types; columns that are all text need no cast.

    The reader reports a line that ends too early and a field of the wrong shape in
    the same way and may keep the fields before the break, so reported lines (and only
    those) are looked at again: one that is no JSON object loses all its fields.
    """
    bad = F.col(BAD_RECORD)
    whole = bad.isNull() | F.json_object_keys(bad).isNotNull()

    def typed(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        return F.when(F.col("_whole"), try_cast_leaves(value, field.dataType)).alias(field.name)

    return raw.withColumn("_whole", whole).select(*[typed(f) for f in schema])


def scan_jsonl_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Scan JSON lines with a schema inferred from every line (one extra pass)."""
    return spark.read.option("samplingRatio", 1.0).json(path)


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines with the file each came from."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file_path"))


def scan_lines_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """The same over a folder that keeps receiving files."""
    return (
        spark.readStream.option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", "true")
        .text(path).select("value", F.col("_metadata.file_path").alias("file_path"))
    )


def parsed_lines(lines: DataFrame, key: str = "id", schema: T.StructType = VACANCY) -> DataFrame:
    """Every line parsed once: (value, file_path, keys, reason, record).

    ``keys`` are the top-level keys, NULL where the line is no JSON object.  ``reason``
    says what a contract scan cannot take over whole, and is NULL for a good line.
    ``broken_line``: not a JSON object.  ``no_key``: parsed, but the key is NULL, so
    silver drops it.  ``bad_field``: kept in silver with at least one field NULLed.
    ``record`` holds the contract columns, all NULL in a broken line.
    """
    parse_as = as_text(schema).add(BAD_RECORD, T.StringType())
    both = F.struct(
        F.from_json("value", parse_as, {"columnNameOfCorruptRecord": BAD_RECORD}).alias("rec"),
        F.json_object_keys("value").alias("keys"),
    )
    # Exploding one element keeps the optimizer from repeating the parse for every use.
    parsed = lines.withColumn("_e", F.explode(F.array(both))).select(*lines.columns, "_e.*")
    rec, whole = F.col("rec"), F.col("keys").isNotNull()
    lost = lost_in_cast(rec, schema)
    bad_field = rec.getField(BAD_RECORD).isNotNull()
    if lost is not None:
        bad_field = bad_field | lost
    reason = (
        F.when(~whole, "broken_line")
        .when(rec.getField(key).isNull(), "no_key")
        .when(bad_field, "bad_field")
    )
    record = F.struct(*[
        F.when(whole, try_cast_leaves(rec.getField(f.name), f.dataType)).alias(f.name) for f in schema
    ])
    return parsed.select(*lines.columns, "keys", reason.alias("reason"), record.alias("record"))


def quarantine(lines: DataFrame, key: str = "id", schema: T.StructType = VACANCY) -> DataFrame:
    """(value, file_path, reason) of the lines ``parsed_lines`` gives a reason for."""
    return parsed_lines(lines, key, schema).select("value", "file_path", "reason").filter(
        F.col("reason").isNotNull()
    )
