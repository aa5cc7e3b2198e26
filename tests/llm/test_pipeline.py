import hashlib
import os
import re
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_line_dedup import plain as plain_runs
from test_mixing import plain_targets
from test_simhash import plain_components, plain_print

import __spark_entry__ as entry
import corpus_pipeline
from compare import compare, duck
from marketlake.llm import decontaminate, line_dedup, quality_classifier, simhash
from marketlake.llm.text import ALNUM, text_chunks

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no generated tables")
SPACE = re.compile("[^\x20\x09-\x0d]+")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name", ["op1_warc", "op2_line_dedup", "op4_mix_sources"])
def test_query_equals_sql(spark, name):
    line = compare(spark, duck(SF), name, SF)
    assert line.startswith("OK"), line


def test_every_operator_is_registered():
    for n in range(1, 11):
        assert [q for q in entry.queries() if q.startswith(f"op{n}_")]
    assert "pipeline" in entry.queries()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "source_mixing"]


def test_stages_follow_from_their_operators(spark):
    """Every stage keeps what its operator's own answers say, over all rows of its input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    stages = dict(corpus_pipeline.STAGES)

    good = stages["quality_classifier"](spark, docs, SF)
    assert good.columns == COLUMNS
    assert ids(good) == ids(quality_classifier.classify(docs, labels).filter("predicted = 1"))

    cut = stages["line_dedup"](spark, docs, SF)
    assert cut.columns == COLUMNS
    found = line_dedup.deduplicate_lines(docs)
    assert ids(cut) == ids(found.filter("lines_removed = 0 or text rlike '[^\\\\x20\\\\x09-\\\\x0D]'"))
    assert cut.filter(F.char_length("text") != F.col("n_chars")).count() == 0

    single = stages["simhash_near_dedup"](spark, docs, SF)
    assert single.columns == COLUMNS
    groups = simhash.near_duplicates(simhash.fingerprints(docs))
    assert ids(single) == sorted(r.component_id for r in groups.select("component_id").distinct().collect())

    clean = stages["benchmark_decontamination"](spark, docs, SF)
    assert clean.columns == COLUMNS
    leaks = set(ids(decontaminate.contaminated(docs, bench)))
    assert leaks and ids(clean) == [k for k in ids(docs) if k not in leaks]

    mixed = stages["source_mixing"](spark, docs, SF)
    assert mixed.columns == [*COLUMNS, "mix_copies"]


def _plain_mix(docs):
    """{id: copies}: sources by code point, targets by resharing, whole texts in order of their mark."""
    sizes = {k: len(SPACE.findall(t)) for k, (t, _) in docs.items()}
    total = defaultdict(int)
    for k, (_, source) in docs.items():
        total[source] += sizes[k]
    copies = {}
    for source, target in plain_targets(dict(total)).items():
        whole = min(int(target // total[source]), 3) if total[source] else 0
        budget = target - whole * total[source]
        mark = lambda k: int(hashlib.md5(f"{k}:{docs[k][0]}".encode()).hexdigest()[:15], 16)
        before = 0
        for k in sorted((k for k in docs if docs[k][1] == source), key=mark):
            more = budget > 0 and 2 * before + sizes[k] <= 2 * budget
            before += sizes[k]
            copies[k] = whole + more if sizes[k] else 0
    return {k: n for k, n in copies.items() if n}


def test_run_equals_plain_python(spark):
    """All stages after the trained one, done again without Spark."""
    found = {r.doc_id: (r.text, r.lang, r.source, r.n_chars, r.mix_copies)
             for r in corpus_pipeline.run(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = quality_classifier.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).filter("predicted = 1")
    rows = {r.doc_id: r for r in docs.join(good, "doc_id", "left_semi").collect()}

    gone = plain_runs([(k, r.text) for k, r in rows.items()], 50)
    texts = {}
    for k, r in rows.items():
        lines = r.text.split("\n")
        kept = "\n".join(x for n, x in enumerate(lines) if (k, n) not in gone)
        if kept == r.text or SPACE.search(kept):
            texts[k] = kept
    root = plain_components({k: plain_print(t) for k, t in texts.items()})
    texts = {k: t for k, t in texts.items() if root[k] == k}

    def read(values):
        out = []
        for chunk in text_chunks(pa.array(values), "unicode"):
            starts, ends, edges = chunk.spans(ALNUM)
            hashes = chunk.hashes(starts, ends)
            out += [hashes[a:b] for a, b in zip(edges[:-1], edges[1:])]
        return out

    items = read([r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    words = dict(zip(texts, read(list(texts.values()))))
    best = [2 * len(x) for x in items]
    leaks = {k for k, w in words.items() if len(w)
             and (decontaminate.align([w] * len(items), items)[0] >= [n / 2 for n in best]).any()}
    assert leaks
    clean = {k: (t, rows[k].source) for k, t in texts.items() if k not in leaks}
    expected = {k: (clean[k][0], rows[k].lang, rows[k].source, len(clean[k][0]), n)
                for k, n in _plain_mix(clean).items()}
    assert found == expected


def test_stages_take_an_empty_table(spark, make_docs):
    docs = make_docs([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
