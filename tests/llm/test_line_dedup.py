import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from llm_data import words
from pyspark.sql import functions as F

from marketlake.llm import line_dedup


def plain(docs, least):
    """Lines to delete, from all windows: {(id, line)}."""
    seen, gone = set(), set()
    order = sorted((d for d in docs if d[1] is not None), key=lambda d: (d[0] is None, d[0] or 0))
    for key, text in order:
        lines = text.split("\n")
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                body = tuple(lines[a:b])
                if sum(len(x.split()) for x in body) < least:
                    continue
                if body in seen:
                    gone.update((key, k) for k in range(a, b))
                seen.add(body)
    return gone


def removed(df):
    return {(r.doc_id, k) for r in df.collect() for k in range(r.start, r.stop)}


def test_runs_equal_all_windows(spark):
    rng = random.Random(5)
    pool = ["a b", "c", "", "d e f", "g h i j", "k", "l m n o p q"]
    for least in (1, 4, 9):
        docs = [(k, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))) for k in range(25)]
        df = spark.createDataFrame(docs, "doc_id long, text string")
        # A window of several copies inside one document starts at different lines: all windows
        # are met in order, so the first of equal windows is the earliest.
        assert removed(line_dedup.repeated_runs(df, least)) == plain(docs, least)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["x", "y z", "", "w w w"]), max_size=9), min_size=1, max_size=6))
def test_any_documents(spark, lines):
    docs = [(k, "\n".join(x)) for k, x in enumerate(lines)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert removed(line_dedup.repeated_runs(df, 3)) == plain(docs, 3)


def test_texts_without_runs_stay_as_they_are(spark, make_docs):
    passage = words(1, 60)
    long = "\n".join(words(k, 12) for k in range(10, 1500))
    rows = [(1, passage + "\nend", "s"), (2, "own line\n" + passage, "s"), (3, None, "s"), (4, "", "s"),
            (5, "short\nshort\nshort", "s"), (None, passage, "s"), (6, long, "s"), (7, long, "s"), (7, long, "s")]
    docs = make_docs(rows, extra=True)
    found = line_dedup.deduplicate_lines(docs)
    got = {(r.doc_id, r.text, r.words_removed) for r in found.collect()}
    assert got == {(1, passage + "\nend", 0), (2, "own line", 60), (3, None, 0), (4, "", 0),
                   (5, "short\nshort\nshort", 0), (None, "", 60), (6, long, 0), (7, "", 1490 * 12)}
    assert found.count() == 9
    cleaned = line_dedup.cleaned_documents(docs)
    assert cleaned.columns == docs.columns
    assert {(r.doc_id, r.n_chars) for r in cleaned.collect()} == {
        (1, len(passage) + 4), (2, 8), (3, None), (4, 0), (5, 17), (6, len(long))}


def test_empty_table(spark, make_docs):
    assert line_dedup.deduplicate_lines(make_docs([], extra=True)).count() == 0


def test_no_words_removed_by_one_line_copies(spark):
    docs = spark.createDataFrame([(k, f"{words(k, 30)}\nsame line here") for k in range(30)], "doc_id long, text string")
    assert line_dedup.deduplicate_lines(docs).agg(F.sum("lines_removed")).first()[0] == 0


def test_a_passage_that_begins_or_ends_inside_a_line_stays(spark):
    """The unit is a whole line, as in the SQL: the README states what that leaves."""
    passage = words(3, 60)
    inside = [f"{words(k, 8)} {passage} {words(k + 10, 8)}" for k in (1, 2)]
    # 45 words of whole lines in common, and 15 more at both ends inside longer lines.
    whole = words(4, 45).replace(" ", "\n")
    across = [f"{words(k, 8)} {words(5, 15)}\n{whole}\n{words(6, 15)} {words(k + 10, 8)}" for k in (21, 22)]
    docs = spark.createDataFrame(list(enumerate([*inside, *across])), "doc_id long, text string")
    kept = {r.doc_id: (r.text, r.words_removed) for r in line_dedup.deduplicate_lines(docs).collect()}
    assert kept == {k: (t, 0) for k, t in enumerate([*inside, *across])}
