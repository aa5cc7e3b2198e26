import random
import re

import numpy as np
from llm_data import clashing, words

from marketlake.llm import decontaminate

WORD = re.compile(r"[0-9a-zA-Z\u0080-\U0010ffff]+")


def plain_score(a, b):
    """(best Smith-Waterman score, where it ends in a)."""
    last, best = [0] * (len(b) + 1), (0, 0)
    for i, x in enumerate(a):
        row = [0]
        for j, y in enumerate(b):
            row.append(max(0, last[j] + (2 if x == y else -1), last[j + 1] - 1, row[j] - 1))
        best = max(best, (max(row), -i - 1))
        last = row
    return best[0], -best[1]


def test_alignment_equals_plain_smith_waterman():
    rng = np.random.default_rng(0)
    a = [rng.integers(5, 12, rng.integers(1, 30)).astype(np.uint64) for _ in range(150)]
    b = [rng.integers(5, 12, rng.integers(1, 20)).astype(np.uint64) for _ in range(150)]
    scores, ends = decontaminate.align(a, b)
    for k in range(150):
        assert plain_score(a[k].tolist(), b[k].tolist()) == (scores[k], ends[k])


def edited(text, seed, share):
    rng = random.Random(seed)
    out = []
    for w in text.split():
        roll = rng.random()
        if roll < share / 2:
            out.append("zz" + w)
        elif roll < share * 3 / 4:
            continue
        elif roll < share:
            out += [w, "qq"]
        else:
            out.append(w)
    return " ".join(out)


def test_pairs_equal_aligning_every_document_with_every_item(spark, make_docs):
    items = {k: words(100 + k, 15 + 5 * k) for k in range(6)}
    rng = random.Random(5)
    rows = []
    for k in range(60):
        text = words(k, 80)
        if k % 3 == 0:
            text += " " + edited(items[rng.randrange(6)], k, rng.choice([0, 0.1, 0.25, 0.6])).upper() + ", " + words(k + 500, 40)
        rows.append((k, text, "s"))
    docs = make_docs(rows, extra=True)
    bench = clashing(spark.createDataFrame(list(items.items()), "item_id long, text string"))
    found = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, bench).collect()}
    expected = {}
    for k, text, _ in rows:
        w = WORD.findall(text.lower())
        for i, item in items.items():
            score = plain_score(w, item.split())[0] / (2 * len(item.split()))
            if score >= decontaminate.THRESHOLD:
                expected[k, i] = score
    assert len(expected) > 8 and set(found) == set(expected)
    for pair, r in found.items():
        assert abs(r.score - expected[pair]) < 1e-9
        assert 0 <= r.first_word < r.end_word <= len(WORD.findall(rows[r.doc_id][1]))
    kept = decontaminate.without_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, _, _ in rows} - {k for k, _ in expected}


def test_an_item_in_very_many_documents_is_found_in_each(spark, make_docs):
    item = words(1001, 25)
    docs = make_docs([(k, f"{words(k, 20)} {item}", "s") for k in range(200)] + [(900, words(900, 60), "s")])
    bench = spark.createDataFrame([(7, item), (8, words(1002, 25))], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()} == {
        (k, 7) for k in range(200)}


def test_seeds_of_one_edited_copy_in_very_many_documents_are_kept(spark, make_docs):
    item = words(1001, 40)
    copy = edited(item, 3, 0.2)
    docs = make_docs([(k, f"{words(k, 20)} {copy}", "s") for k in range(150)])
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert plain_score(copy.split(), item.split())[0] >= 40
    assert decontaminate.contaminated(docs, bench).count() == 150


def test_blocks_give_the_same_pairs(spark, make_docs):
    items = [(k, words(k, 20)) for k in range(12)]
    docs = make_docs([(k, f"{words(k + 50, 15)} {t}", "s") for k, t in items])
    bench = spark.createDataFrame(items, "item_id long, text string")
    blocks = list(decontaminate.blocks(bench, block_words=60))
    assert len(blocks) == 5 and sorted(i for b in blocks for i in b.ids) == list(range(12))
    assert decontaminate.contaminated(docs, bench).count() == 12


def test_short_items_nulls_and_empty_tables(spark, make_docs):
    bench = spark.createDataFrame([(1, "rareword"), (2, None), (3, ""), (4, "two words")], "item_id long, text string")
    docs = make_docs([(1, "a rareword here", "s"), (None, "two words", "s"), (3, None, "s"), (4, "", "s"),
                      (5, "words two", "s"), (1, "a rareword here", "s")], extra=True)
    found = sorted(((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()), key=repr)
    assert found == [(1, 1), (1, 1), (None, 4)]
    assert decontaminate.contaminated(make_docs([]), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.without_contaminated(docs, bench.limit(0)).count() == 6


def test_rows_kept_are_written_between_blocks(spark, make_docs, monkeypatch):
    """Five blocks: the plan that is left holds one of them, and the rows are those of one block."""
    bench = spark.createDataFrame([(k, words(k, 20)) for k in range(12)], "item_id long, text string")
    rows = [(k, words(k, 20) if k < 12 else words(100 + k, 30), "s") for k in range(40)]
    docs = make_docs([*rows, (None, None, "s"), (7, "", None)], extra=True)
    whole = decontaminate.without_contaminated(docs, bench)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 60)
    kept = decontaminate.without_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.exceptAll(whole).count() == 0 == whole.exceptAll(kept).count()
    assert kept.count() == 30
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert all("clean_docs" in path for path in kept.inputFiles())


def found_in(texts, items):
    chunks = list(decontaminate.text_chunks(decontaminate.pa.array(texts, decontaminate.pa.string()), lower="unicode"))
    hashed = []
    for chunk in decontaminate.text_chunks(decontaminate.pa.array(items, decontaminate.pa.string()), lower="unicode"):
        h, edges = decontaminate._hashes(chunk)
        hashed += [h[a:b] for a, b in zip(edges[:-1], edges[1:])]
    block = decontaminate._build(list(range(len(items))), hashed)
    return {(c.first_row + d, i): (score, end) for c in chunks
            for d, i, score, _, end in decontaminate.find(block, block.bitmap(), c, decontaminate.THRESHOLD)}


def test_passages_in_pieces_and_small_batches_equal_whole_ones(monkeypatch):
    """Texts that repeat parts of items many times, so that passages are many items long; ties between places."""
    monkeypatch.setattr(decontaminate, "BATCH_PLACES", 7)
    monkeypatch.setattr(decontaminate, "BATCH_WORDS", 300)
    rng = random.Random(3)
    items = [words(k, 6 + k) for k in range(5)] + ["a a a a a a b"]
    texts = []
    for k in range(25):
        parts = []
        for _ in range(rng.randrange(1, 30)):
            t = rng.choice(items).split()
            a = rng.randrange(len(t) - 3)
            parts += t[a: a + rng.randrange(3, len(t))] + words(rng.randrange(99), rng.randrange(3)).split()
        texts.append(" ".join(parts))
    expected = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            score, end = plain_score(text.split(), item.split())
            if score >= decontaminate.THRESHOLD * 2 * len(item.split()):
                expected[d, i] = (score / (2 * len(item.split())), end)
    assert len(expected) > 40 and found_in(texts, items) == expected


def test_a_very_long_text_of_one_shared_phrase_takes_bounded_memory():
    """200 000 words of a phrase that 30 items share; the whole passages would be 30 x 200 000 words."""
    import tracemalloc

    phrase = words(1, 13)
    items = [f"{phrase} {words(50 + k, 30)}" for k in range(30)] + [phrase]
    text = " ".join([phrase] * 15_400)
    tracemalloc.start()
    found = found_in([text], items)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == {(0, 30): (1.0, 13)}
    assert peak < 400e6
