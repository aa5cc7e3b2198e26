"""Parquet footers as rows: what the files of a table hold, without reading their data."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_FOOTER = ("file_path string, row_cnt long, row_group_cnt int, largest_row_group long, codecs array<string>, "
           "columns array<struct<name:string,type:string>>")


def parquet_footers(spark: SparkSession, path: str) -> DataFrame:
    """One row a Parquet file under ``path``: its rows, row groups, codecs and top-level columns.

    ``largest_row_group`` is a number of rows; columns have their Arrow types, in file order.
    Spark lists the files and deals them to tasks, which read the end of each file only, so
    the bytes read do not grow with the rows.  Files whose names start with ``_`` or ``.`` are
    no data files and are left out; one that is no Parquet file fails the job.  Tasks open
    files through ``pyarrow.fs``, which must know the store (local, hdfs, s3, gs, abfs).
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet").load(path).select("path")
    )

    def run(batches: Iterator) -> Iterator:
        import re

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        kind = pa.struct([("name", pa.string()), ("type", pa.string())])
        fields = pa.schema([
            ("file_path", pa.string()), ("row_cnt", pa.int64()), ("row_group_cnt", pa.int32()),
            ("largest_row_group", pa.int64()), ("codecs", pa.list_(pa.string())), ("columns", pa.list_(kind))])
        for batch in batches:
            rows = []
            for file_path in batch.column(0).to_pylist():
                uri = re.sub("^file:/+", "file:///", re.sub("^s3a:", "s3:", file_path))
                store, inside = fs.FileSystem.from_uri(uri)
                with store.open_input_file(inside) as source:
                    footer = pq.read_metadata(source)
                groups = [footer.row_group(k) for k in range(footer.num_row_groups)]
                codecs = {g.column(c).compression for g in groups for c in range(g.num_columns)}
                rows.append({
                    "file_path": file_path, "row_cnt": footer.num_rows, "row_group_cnt": len(groups),
                    "largest_row_group": max((g.num_rows for g in groups), default=0), "codecs": sorted(codecs),
                    "columns": [{"name": f.name, "type": str(f.type)} for f in footer.schema.to_arrow_schema()],
                })
            yield pa.RecordBatch.from_pylist(rows, fields)

    return files.mapInArrow(run, _FOOTER)


def columns_per_parquet_file(footers: DataFrame) -> DataFrame:
    """(file_path, row_cnt, column_cnt) from ``parquet_footers``."""
    return footers.select("file_path", "row_cnt", F.size("columns").cast("bigint").alias("column_cnt"))


def column_changes(footers: DataFrame, by: Column, by_name: str) -> DataFrame:
    """Per group of files, in order of ``by``: columns, and those added, dropped or retyped.

    (by_name, file_cnt, row_cnt, column_cnt, added, dropped, retyped); the lists are sorted
    and relate to the group before, so they are empty in the first one.  A group has the
    columns that any of its files has, and a column with several types in it counts once.
    The window runs over a row a group.
    """
    per_group = footers.groupBy(by.alias(by_name)).agg(
        F.count(F.lit(1)).alias("file_cnt"), F.sum("row_cnt").alias("row_cnt"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("columns")))).alias("_have"))
    names = F.array_distinct(F.col("_have")["name"])
    before = Window.orderBy(by_name)
    told = per_group.withColumn("_names", names).withColumns({
        "_old": F.coalesce(F.lag("_have").over(before), F.col("_have")),
        "_old_names": F.coalesce(F.lag("_names").over(before), F.col("_names"))})
    changed = F.array_union(F.array_except("_have", "_old"), F.array_except("_old", "_have"))
    both = F.array_intersect("_names", "_old_names")
    return told.select(
        by_name, "file_cnt", "row_cnt", F.size("_names").cast("bigint").alias("column_cnt"),
        F.array_sort(F.array_except("_names", "_old_names")).alias("added"),
        F.array_sort(F.array_except("_old_names", "_names")).alias("dropped"),
        F.array_sort(F.array_intersect(both, changed["name"])).alias("retyped"))
