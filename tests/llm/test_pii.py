import hashlib
import random
import re

import pandas as pd
from llm_data import words

from marketlake.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text)
            if 14 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    pieces = ["1", "2", "25", ".", ".", "@", "a", "b-", "-", " ", "+", "(", ")", "é", "com", "4111111111111111", "300", "%"]
    for _ in range(20_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "a@" * 50_000, "1." * 100_000, "+1" * 50_000):
        pii.base_spans(text)


def test_spans_counts_and_digest(spark, make_docs):
    texts = [f"{words(k, 20)} mail me@site{k}.com or card 4111 1111 1111 1111 😀 from 10.0.0.{k} call +1 (415) 555-2671 x"
             for k in range(20)]
    texts += [f'{words(k, 9)} token = "{hashlib.sha1(str(k).encode()).hexdigest()}" {words(k + 1, 9)}' for k in range(20)]
    texts += [f"{words(k, 9)} {4111111111111112 + 10 * k} {words(k, 5)}" for k in range(10)]
    texts += [None, "", words(5, 50), words(6, 30_000) + " a@b.co"]
    docs = make_docs([(k, t, "s") for k, t in enumerate(texts)], extra=True)
    found = pii.find_personal_data(docs).collect()
    assert len(found) == len(texts)
    for r in found:
        base = plain(texts[r.doc_id] or "")
        assert r.base == ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in base) for j in range(4)]
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert set(r.base.split(",")) - {""} <= set(r.spans.split(","))
        order = [(int(a), pii.KINDS.index(k)) for k, a, _ in spans]
        assert order == sorted(order)
    by_id = {r.doc_id: r.spans for r in found}
    assert all("secret:" in by_id[k] for k in range(20, 40))
    assert all(by_id[k].count("card:") == 1 for k in range(40, 50))
    assert by_id[50] == by_id[51] == by_id[52] == ""


def test_expectation_maximisation_rates_labelers():
    rng = random.Random(3)
    rows = []
    for _ in range(2000):
        true = rng.random() < 0.4
        right = [0.95, 0.9, 0.6, 0.85, 0.5]
        votes = "".join("+" if (rng.random() < p) == true else "-" for p in right)
        rows.append(f"2{votes}23")
    counts = pd.Series(rows).value_counts().rename_axis("signature").reset_index(name="n")
    belief, table = pii.reliabilities(counts)
    accuracy = [(table[1, 2, v, 2] + table[0, 2, v, 0]) / 2 for v in range(5)]
    assert accuracy[0] > accuracy[2] > accuracy[4] - 0.05 and accuracy[0] > 0.9
    assert abs((belief * counts["n"]).sum() / 2000 - 0.4) < 0.06


def test_nothing_proposed_and_empty(spark, make_docs):
    assert [r.spans for r in pii.find_personal_data(make_docs([(None, "no data", "s"), (1, None, "s")])).collect()] == ["", ""]
    assert pii.find_personal_data(make_docs([])).count() == 0
