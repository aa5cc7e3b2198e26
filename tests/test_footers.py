"""Footers tell columns, rows and codecs of files whose data cannot even be read."""

import glob
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from marketlake.sources.footers import column_changes, columns_per_parquet_file, parquet_footers
from marketlake.sources.tables import path_date


def part(spark, folder, day, exprs, n=1, codec="zstd"):
    spark.range(n).selectExpr(*exprs).coalesce(1).write.option("compression", codec).parquet(f"{folder}/date={day}")


def test_rows_codecs_and_row_groups(spark, tmp_path):
    part(spark, tmp_path, "2025-01-01", ["id", "named_struct('x', id) as s"], 1000)
    part(spark, tmp_path, "2025-01-02", ["id"], 0, "snappy")
    got = parquet_footers(spark, str(tmp_path)).orderBy("row_cnt").collect()
    assert [(r.row_cnt, r.largest_row_group, len(r.columns)) for r in got] == [(0, 0, 1), (1000, 1000, 2)]
    assert got[1].codecs == ["ZSTD"] and got[1].columns[0].type == "int64" and got[1].row_group_cnt == 1


def test_changes_between_days(spark, tmp_path):
    part(spark, tmp_path, "2025-01-01", ["id", "id as a"])
    part(spark, tmp_path, "2025-01-02", ["id", "cast(id as string) as a", "id as b"], 2)
    spark.range(3).selectExpr("id", "id as c").coalesce(1).write.mode("append").parquet(f"{tmp_path}/date=2025-01-02")
    part(spark, tmp_path, "2025-01-04", ["id"])
    got = column_changes(parquet_footers(spark, str(tmp_path)), path_date(F.col("file_path")), "day")
    told = [(r.day.day, r.file_cnt, r.row_cnt, r.column_cnt, r.added, r.dropped, r.retyped)
            for r in got.orderBy("day").collect()]
    assert told == [(1, 1, 1, 2, [], [], []), (2, 2, 5, 4, ["b", "c"], [], ["a"]),
                    (4, 1, 1, 1, [], ["a", "b", "c"], [])]


def test_no_data_page_is_read(spark, tmp_path):
    """A file whose pages are overwritten by zeros still tells its columns."""
    part(spark, tmp_path, "2025-01-01", ["id", "uuid() as u"], 20_000)
    name, = glob.glob(f"{tmp_path}/date=*/*.parquet")
    size = os.path.getsize(name)
    with open(name, "r+b") as file:
        file.seek(4)
        file.write(bytes(size // 2))
    for crc in glob.glob(f"{tmp_path}/date=*/.*.crc"):
        os.truncate(crc, 0)
    assert rows(columns_per_parquet_file(parquet_footers(spark, str(tmp_path))).drop("file_path")) == [(20_000, 2)]


def test_a_file_that_is_no_parquet_fails(spark, tmp_path):
    (tmp_path / "x.parquet").write_bytes(b"no footer at all")
    with pytest.raises(Exception, match="(?i)parquet"):
        parquet_footers(spark, str(tmp_path)).collect()
