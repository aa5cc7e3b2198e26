"""Dumps with bad bytes, quoting, ragged rows and unreadable dates."""

from conftest import rows
from marketlake.plans.historical import (
    CANONICAL,
    DUMPS,
    Dump,
    canonical_dumps,
    consolidate,
    left_out,
    merge_dumps,
    to_canonical,
)
from marketlake.sources.dumps import files_with_line_breaks, scan_dump

A = Dump("a.csv", ";", "dd.MM.yyyy HH:mm",
         {"vacancy_id": "id_vac", "vacancy_name": "name", "date_published": "published_at",
          "salary_from": "salary"}, multiline=True)
B = Dump("b.csv", "|", "yyyy-MM-dd HH:mm:ss[XXX][XX]",
         {"vacancy_id": "id", "date_published": "at", "data_source": "src"})


def folder(tmp_path):
    (tmp_path / "a.csv").write_bytes(
        "id_vac;name;published_at;salary\n"
        '1;"x; ""y""";01.06.2022 10:30;100\n'
        '1;older;01.05.2022 10:30;50\n'
        '2;"two\nlines";31.31.2022 10:30;\n'
        ';no id;01.06.2022 10:30;1\n'
        '3;;01.01.2012 00:00;7;surplus\n'
        '4;short\n'.encode() + b"5;bad \xff byte;01.06.2022 10:30;1\n"
    )
    (tmp_path / "b.csv").write_text(
        "id|at|src\n1|2022-06-01 10:00:00+0500|sj\n2|2022-06-01 10:00:00+03:00|\n")
    return str(tmp_path)


def test_edge_rows(spark, tmp_path):
    df = consolidate(spark, folder(tmp_path), [A, B])
    assert tuple(df.columns) == CANONICAL
    assert rows(df) == sorted([
        ("1", 'x; "y"', "2022-06-01T10:30:00+0300", "100", "hh", "a.csv"),
        ("2", "two\nlines", None, None, "hh", "a.csv"),
        ("3", None, "2012-01-01T00:00:00+0400", "7", "hh", "a.csv"),
        ("4", "short", None, None, "hh", "a.csv"),
        ("5", "bad � byte", "2022-06-01T10:30:00+0300", "1", "hh", "a.csv"),
        ("1", None, "2022-06-01T08:00:00+0300", None, "sj", "b.csv"),
        ("2", None, "2022-06-01T10:00:00+0300", None, None, "b.csv"),
    ], key=repr)


def test_strict_mode_needs_a_name(spark, tmp_path):
    df = consolidate(spark, folder(tmp_path), [A, B], ("vacancy_id", "vacancy_name"))
    assert {r["vacancy_id"] for r in df.collect()} == {"1", "2", "4", "5"}


def test_equal_keys_do_not_depend_on_order(spark, tmp_path):
    raw = scan_dump(spark, folder(tmp_path) + "/a.csv", ";", multiline=True)
    one = to_canonical(raw, A)
    assert rows(merge_dumps([one, one])) == rows(merge_dumps([one]))


def test_declared_dumps():
    assert len(DUMPS) == 6
    assert sum("vacancy_id" not in d.columns for d in DUMPS) == 1


def test_a_dump_without_ids_is_kept_and_losses_are_counted(spark, tmp_path):
    (tmp_path / "c.csv").write_text("title,at\nx,2022-06-01\ny,2022-06-02\nx,2022-06-01\n,\n")
    c = Dump("c.csv", ",", "yyyy-MM-dd", {"vacancy_name": "title", "date_published": "at"})
    where = folder(tmp_path)
    out = consolidate(spark, where, [A, B, c])
    assert [r["vacancy_name"] for r in out.filter("file_source = 'c.csv'").orderBy("vacancy_name").collect()] == [
        None, "x", "y"]
    assert rows(left_out(canonical_dumps(spark, where, [A, B, c]))) == [("a.csv", 7, 1), ("b.csv", 2, 0), ("c.csv", 4, 0)]


def test_quoted_line_breaks_are_found_without_being_declared(spark, tmp_path):
    """A default dump of three files; line breaks in a field of one and in the header of two."""
    part = tmp_path / "d.csv"
    part.mkdir()
    (part / "1.csv").write_text('id;name;"no\nte"\n1;"a ""b""";x\n')
    (part / "2.csv").write_text('id;name;"no\nte"\n2;"two; ""q""\nthree\n\n4;5";y\n3;"z";\n')
    (part / "3.csv").write_text('id;name;note\n4;plain;x\n5;"p";y\n')
    d = Dump("d.csv", ";", "yyyy-MM-dd", {"vacancy_id": "id", "vacancy_name": "name"})
    found = consolidate(spark, str(tmp_path), [d]).select("vacancy_id", "vacancy_name")
    assert rows(found) == [("1", 'a "b"'), ("2", 'two; "q"\nthree\n\n4;5'), ("3", "z"), ("4", "plain"), ("5", "p")]
    assert [f[-5:] for f in sorted(files_with_line_breaks(spark, str(part)))] == ["1.csv", "2.csv"]
    assert rows(left_out(canonical_dumps(spark, str(tmp_path), [d]))) == [("d.csv", 5, 0)]
