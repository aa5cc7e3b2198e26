import gzip
import hashlib
import os

import pytest
from llm_data import clashing, words
from pyspark.sql import functions as F

from marketlake.llm import warc
from marketlake.session import scratch_path

SCHEMA = "page_id long, url string, html string"


def plain(rows):
    largest = {}
    for k, _, html in rows:
        largest[html or ""] = max(largest.get(html or "", -1), -1 if k is None else k)
    out = []
    for k, url, html in rows:
        body = (html or "").encode()
        origin = largest[html or ""]
        again = len(body) >= 1000 and origin >= 0 and k != origin
        out.append((k, url, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response",
                    origin if again else None))
    return sorted(out, key=repr)


def test_round_trip(spark):
    big, tricky = words(1, 400), "é\r\n\r\nWARC/1.1\r\n\r\n" + words(2, 300)
    rows = [(1, "u1", big), (5, "u5", big), (3, None, big), (None, "n", big), (2, "a\r\nb", "short"), (4, "u4", "short"),
            (6, "u6", None), (7, "u7", ""), (8, "u8", tricky), (9, "u9", tricky), (9, "u9", tricky),
            (10, "x", "a" * 1000), (11, "x", "a" * 1000), (12, "x", "a" * 999), (13, "x", "a" * 999),
            (14, "long", words(3, 60_000))]
    pages = clashing(spark.createDataFrame(rows, SCHEMA)).repartition(5)
    found = [tuple(r) for r in warc.archive_pages(pages, spark).collect()]
    expected = [(k, None if u is None else u.replace("\r\n", "  "), *rest) for k, u, *rest in plain(rows)]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_archives_are_gzip_members_and_the_index_places_them(spark):
    rows = [(k, f"http://h/{k}", words(k, 50)) for k in range(40)]
    records = warc.plan_records(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("page_id"), F.col("url"),
                                F.col("html"))
    files = warc.write_archives(records, scratch_path(spark, "warc-test"))
    assert files.agg(F.sum("records")).first()[0] == 40
    index = warc.index_archives(files).orderBy("file", "offset").collect()
    place = {}
    for r in index:
        assert r.offset == place.get(r.file, 0)
        place[r.file] = r.offset + r.length
        with open(r.file, "rb") as f:
            f.seek(r.offset)
            record = gzip.decompress(f.read(r.length))
        assert record.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
        assert f"WARC-Target-URI: {r.url}\r\n".encode() in record
    assert all(os.path.getsize(f) == size for f, size in place.items())


def test_selected_records_only_and_damage_is_noticed(spark):
    rows = [(k, f"http://h/{k}", words(k, 200)) for k in range(30)]
    records = warc.plan_records(spark.createDataFrame(rows, SCHEMA), F.col("page_id"), F.col("url"), F.col("html"))
    index = warc.index_archives(warc.write_archives(records, scratch_path(spark, "warc-test")))
    some = index.filter(F.col("record_id").cast("long") % 7 == 0)
    got = {int(r.record_id): r.payload for r in warc.read_records(some).collect()}
    assert got == {k: words(k, 200) for k in range(0, 30, 7)}
    with pytest.raises(Exception, match="not the one indexed"):
        warc.read_records(some.withColumn("payload_digest", F.lit("0" * 40))).collect()


def test_empty_table(spark):
    assert warc.archive_pages(spark.createDataFrame([], SCHEMA), spark).count() == 0
