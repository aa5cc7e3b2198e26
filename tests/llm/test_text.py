"""The numpy kernel against plain Python."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from marketlake.llm import text
from marketlake.llm.document_stats import measure

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(value):
    w = WORD.findall(value)
    windows = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    covered = [False] * len(w)
    for k in range(len(w) - 4):
        if windows[tuple(w[k:k + 5])] > 1:
            covered[k:k + 5] = [True] * 5
    lines = [x for x in value.split("\n") if WORD.search(x)]
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", value)), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": sum(covered), "n_lines": len(lines), "n_distinct_words": len(set(w)),
        "n_top_word": max(collections.Counter(w).values(), default=0),
        "longest_word": max(map(len, w), default=0), "n_echoes": sum(a == b for a, b in zip(w, w[1:])),
    }


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t#\x0b😀", max_size=60)), max_size=6))
def test_measures_equal_plain_python(texts):
    found = collections.defaultdict(list)
    for chunk in text.text_chunks(pa.array(texts, pa.string())):
        for name, values in measure(chunk).items():
            found[name] += values.tolist()
    for k, value in enumerate(texts):
        for name, expected in plain(value or "").items():
            assert found[name][k] == expected, (name, value)


def test_chunks_hold_whole_documents_of_any_length(monkeypatch):
    monkeypatch.setattr(text, "CHUNK_BYTES", 50)
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab \n") for _ in range(rng.choice([0, 3, 40, 400]))) for _ in range(40)]
    sizes = [c.n_docs for c in text.text_chunks(pa.array(texts))]
    assert sum(sizes) == 40 and len(sizes) > 5
    found = [n for c in text.text_chunks(pa.array(texts)) for n in measure(c)["n_words"].tolist()]
    assert found == [len(WORD.findall(t)) for t in texts]


def test_equal_words_have_equal_hashes_anywhere():
    chunk = next(iter(text.text_chunks(pa.array(["one two", "x one", "two one two"]))))
    starts, ends, edges = chunk.spans(text.NOT_SPACE)
    h = chunk.hashes(starts, ends)
    assert h[0] == h[3] == h[5] and h[1] == h[4] == h[6] and len(set(h.tolist())) == 3
    grams, at = text.ngrams(h, edges, 2)
    assert at.tolist() == [0, 2, 4, 5] and grams[0] == grams[3] and len(np.unique(grams)) == 3


def test_lower_folds_ascii_or_all():
    read = lambda how: bytes(next(iter(text.text_chunks(pa.array(["AÉ"]), how))).data).decode()
    assert (read(""), read("ascii"), read("unicode")) == ("AÉ", "aÉ", "aé")
