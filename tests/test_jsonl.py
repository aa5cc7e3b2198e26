"""Contract scan of hand-made lines: every kind of damage, none of it fatal."""

import gzip
import json

from pyspark.sql import functions as F

from marketlake.operators.profile import empty_list_report, null_report
from marketlake.operators.quality import drift_report, missing_columns
from marketlake.sources.contract import VACANCY, as_text
from marketlake.sources.jsonl import quarantine, scan_jsonl, scan_lines

GOOD = {"id": "1", "name": "a", "salary": {"from": 10, "to": 20, "currency": "RUR", "gross": True},
        "relations": [], "work_format": None, "sort_point_distance": 7.0,
        "published_at": "2025-12-04T10:09:13+0300"}
LINES = {
    "good": json.dumps(GOOD),
    "broken": "{bad",
    "cut": json.dumps({**GOOD, "id": "cut", "snippet": {"requirement": "x"}})[:-4],
    "bad_leaf": '{"id":"3","salary":{"from":1,"to":"x"}}',
    "bad_struct": '{"id":"4","salary":"oops"}',
    "text_number": '{"id":5,"sort_point_distance":"7","internship":"true"}',
    "null_id": '{"id":null,"name":"n"}',
    "no_id": '{"name":"n"}',
    "extra": '{"id":"7","extra":1}',
    "bad_in_list": '{"id":"8","address":{"metro_stations":[{"lat":"x"},{"lat":1.5}]}}',
}


def write(tmp_path, lines, name="date=2025-12-04/part_0001.jsonl.gz"):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return str(tmp_path)


def test_contract_has_49_columns_and_all_text_twin():
    assert len(VACANCY) == 49
    assert as_text(VACANCY)["salary"].dataType["from"].dataType.simpleString() == "string"


def test_scan_keeps_what_can_be_kept(spark, tmp_path):
    df = scan_jsonl(spark, write(tmp_path, LINES.values()))
    assert df.columns == VACANCY.fieldNames()
    assert df.schema["salary"].dataType == VACANCY["salary"].dataType
    by_id = {r["id"]: r for r in df.filter("id is not null").collect()}
    assert set(by_id) == {"1", "3", "4", "5", "7", "8"}
    assert (by_id["3"]["salary"]["from"], by_id["3"]["salary"]["to"]) == (1, None)
    assert by_id["4"]["salary"] is None
    assert by_id["5"]["sort_point_distance"] == 7.0 and by_id["5"]["internship"] is True
    assert [m["lat"] for m in by_id["8"]["address"]["metro_stations"]] == [None, 1.5]
    # The two broken lines stay as all-NULL rows.
    assert df.count() == len(LINES)
    assert df.filter(F.coalesce("id", "name", "published_at").isNull()).count() == 2


def test_pruned_scan_gives_the_same_rows(spark, tmp_path):
    path = write(tmp_path, LINES.values())
    wide = {r["id"] for r in scan_jsonl(spark, path).collect()}
    narrow = {r["id"] for r in scan_jsonl(spark, path).select("id").collect()}
    assert wide == narrow


def test_quarantine_reasons(spark, tmp_path):
    bad = quarantine(scan_lines(spark, write(tmp_path, LINES.values())))
    got = {r["value"]: r["reason"] for r in bad.collect()}
    assert got == {
        LINES["broken"]: "broken_line", LINES["cut"]: "broken_line",
        LINES["null_id"]: "no_key", LINES["no_id"]: "no_key",
        LINES["bad_leaf"]: "bad_field", LINES["bad_struct"]: "bad_field",
        LINES["bad_in_list"]: "bad_field",
    }


def test_drift_report_reads_every_line(spark, tmp_path):
    path = write(tmp_path, LINES.values())
    got = {r["column"]: (r["status"], r["line_cnt"])
           for r in drift_report(scan_lines(spark, path), VACANCY).collect()}
    assert got["extra"] == ("new", 1)
    assert got["video_vacancy"] == ("missing", 0)
    assert got["id"] == ("known", 7)
    assert len(got) == 50


def test_missing_columns_per_file(spark, tmp_path):
    write(tmp_path, ['{"id":"1","a":1}'], "part_1.jsonl.gz")
    path = write(tmp_path, ['{"id":"2"}', '{"id":"3","b":1}'], "part_2.jsonl.gz")
    got = {(r["file_path"].rsplit("/", 1)[1], r["column"])
           for r in missing_columns(scan_lines(spark, path)).collect()}
    assert got == {("part_2.jsonl.gz", "a"), ("part_1.jsonl.gz", "b")}


def test_empty_list_is_not_null(spark, tmp_path):
    df = scan_jsonl(spark, write(tmp_path, [LINES["good"]]))
    nulls = {r["column"]: r["null_cnt"] for r in null_report(df).collect()}
    empty = {r["column"]: r["empty_list_cnt"] for r in empty_list_report(df).collect()}
    assert (nulls["relations"], empty["relations"]) == (0, 1)
    assert (nulls["work_format"], empty["work_format"]) == (1, 0)
