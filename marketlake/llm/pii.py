"""Personal data by weak supervision.

Base patterns find e-mail addresses, IP addresses, card and phone numbers exactly.
Wider patterns propose further spans; labelers (strict form, gazetteers, context words,
length, surroundings) vote on each.  Expectation maximisation over the counts of vote
patterns estimates how reliable each labeler is, without hand labels, and its
posteriors train a span classifier that decides on the proposals.  Texts are read once;
what leaves a task are spans, and what reaches the driver are counts of vote patterns,
whose number is bounded by their form.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.text import small_batches
from marketlake.session import materialize

#: Kinds in the order in which spans with one start are listed; the last two are the method's own.
KINDS = ["email", "ip", "card", "phone", "secret", "national_id"]
BASE_KINDS = KINDS[:4]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")

_WIDE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,64}(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]{1,64})+"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,18}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
    "secret": re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"),
    "national_id": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
}
#: Gazetteers and context words: fixed values.
_TLD = {"com", "org", "net", "edu", "gov", "io", "info", "de", "fr", "es", "uk", "eu", "ru", "test"}
_CONTEXT = {
    "email": ("mail", "contact", "write to"), "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "mastercard", "payment"), "phone": ("call", "tel", "phone", "fax", "mobile"),
    "secret": ("token", "key", "secret", "password", "passwd"), "national_id": ("ssn", "social security", "id"),
}
_AGAINST = ("version", "isbn", "issn", "page", "chapter", "figure", "sha", "commit", "http")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if k % 2:
            v = v * 2 - 9 * (v > 4)
        total += v
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern, found from their @ so that long words cost little."""
    begin, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > begin and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            begin = domain.end()
        at = text.find("@", max(at + 1, begin))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers at a time from chains of dotted numbers; none may exceed 255."""
    for chain in _DOTTED.finditer(text):
        parts = chain[0].split(".")
        at = chain.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k: k + 4]
            length = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                yield at, at + length
            at += length + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, sorted."""
    found = []
    if "@" in text:
        found += [(a, 0, b) for a, b in _emails(text)]
    if "." in text:
        found += [(a, 1, b) for a, b in _ips(text)]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def _votes(kind: str, text: str, start: int, end: int) -> tuple[int, ...]:
    """Votes of the five labelers: 1 for personal data, -1 against, 0 undecided."""
    span = text[start:end]
    digits = re.sub(r"[^0-9]", "", span)
    before = text[max(0, start - 30): start].lower()
    if kind == "card":
        form = 1 if luhn(digits) else 0
        listed = 1 if digits[0] in "3456" else 0
        length = 1 if len(digits) in (15, 16) else 0
    elif kind == "phone":
        form = 1 if span[0] == "(" else 0
        listed = 1 if digits[0] not in "01" else 0
        length = 1 if len(digits) == 10 else -1
    elif kind == "secret":
        hexed = re.fullmatch(r"[0-9A-Fa-f]+", span) is not None
        form = 1 if hexed else (0 if digits and not span.isdigit() else -1)
        listed = 0 if digits else -1
        length = 1 if len(span) in (32, 40, 64) else 0
    elif kind == "email":
        form, length = 1, 1 if len(span) < 80 else -1
        listed = 1 if re.split(r"[^A-Za-z0-9]+", span.lower().rstrip(")] "))[-1] in _TLD else 0
    else:
        form = 1
        listed = -1 if span[:3] in ("000", "666") or span[0] == "9" else 1
        length = 1
    context = 1 if any(w in before for w in _CONTEXT[kind]) else (-1 if any(w in before for w in _AGAINST) else 0)
    beside = text[start - 1: start] + text[end: end + 1]
    alone = -1 if any(c.isalnum() for c in beside) else 1
    return form, listed, context, length, alone


def _signature(kind: str, text: str, start: int, end: int) -> str:
    """Kind, votes and shape as one word; there are finitely many."""
    span = text[start:end]
    digits = sum(c.isdigit() for c in span)
    size = min((end - start) // 8, 8)
    votes = "".join("-0+"[v + 1] for v in _votes(kind, text, start, end))
    return f"{KINDS.index(kind)}{votes}{size}{4 * digits // len(span)}"


def proposals(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, signature) of wider matches clear of all base spans."""
    found = []
    for kind, pattern in _WIDE.items():
        k = KINDS.index(kind)
        for m in pattern.finditer(text):
            if any(a < m.end() and m.start() < b for a, _, b in base):
                continue
            if kind == "secret" and not (re.search(r"[0-9]", m[0]) and re.search(r"[A-Za-z]", m[0])):
                continue
            found.append((m.start(), k, m.end(), _signature(kind, text, m.start(), m.end())))
    return sorted(found)


@dataclass
class SpanModel:
    """Weights of the span classifier over signature features."""

    weights: np.ndarray

    def probability(self, signatures: list[str]) -> np.ndarray:
        if not signatures:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(_design(signatures) @ self.weights, -30, 30)))


def _design(signatures: list[str]) -> np.ndarray:
    """Kind, the three values of each vote, size and share of digits as indicators."""
    out = np.zeros((len(signatures), 1 + len(KINDS) + 15 + 9 + 5))
    for k, s in enumerate(signatures):
        out[k, 0] = 1
        out[k, 1 + int(s[0])] = 1
        for v, c in enumerate(s[1:6]):
            out[k, 1 + len(KINDS) + 3 * v + "-0+".index(c)] = 1
        out[k, 16 + len(KINDS) + int(s[6])] = 1
        out[k, 25 + len(KINDS) + int(s[7])] = 1
    return out


def reliabilities(counts: pd.DataFrame, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """(posterior of each signature, labelers' vote probabilities [class, kind, labeler, vote]).

    ``counts`` holds (signature, n).  The posterior starts from the votes' majority; vote
    probabilities are smoothed by one imagined vote, a correct one.
    """
    kind = counts["signature"].str[0].astype(int).to_numpy()
    votes = np.array([["-0+".index(c) for c in s[1:6]] for s in counts["signature"]]).reshape(-1, 5)
    n = counts["n"].to_numpy(float)
    belief = np.clip(0.5 + 0.15 * (votes - 1).sum(axis=1), 0.05, 0.95)
    table = np.zeros((2, len(KINDS), 5, 3))
    for _ in range(rounds):
        prior = np.zeros((2, len(KINDS)))
        for c, weight in ((0, n * (1 - belief)), (1, n * belief)):
            table[c] = 0.5
            table[c, :, :, 2 if c else 0] += 1.0
            for v in range(5):
                np.add.at(table[c, :, v], (kind, votes[:, v]), weight)
            table[c] /= table[c].sum(axis=2, keepdims=True)
            np.add.at(prior[c], kind, weight)
        odds = np.log((prior[1, kind] + 1) / (prior[0, kind] + 1))
        for v in range(5):
            odds += np.log(table[1, kind, v, votes[:, v]] / table[0, kind, v, votes[:, v]])
        belief = np.clip(1 / (1 + np.exp(-np.clip(odds, -30, 30))), 1e-4, 1 - 1e-4)
    return belief, table


def train(counts: pd.DataFrame, ridge: float = 1.0) -> SpanModel:
    """Logistic regression on the posteriors, by Newton steps over distinct signatures."""
    size = 1 + len(KINDS) + 15 + 9 + 5
    if not len(counts):
        return SpanModel(np.zeros(size))
    counts = counts.sort_values("signature")
    belief, _ = reliabilities(counts)
    x, n = _design(list(counts["signature"])), counts["n"].to_numpy(float)
    n = n / n.mean()
    w = np.zeros(size)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - belief)) + ridge * 0.01 * w
        curve = (x * (n * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * 0.01 * np.eye(size)
        w -= np.linalg.solve(curve, gradient)
    return SpanModel(w)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base, proposed): one row a row, read once.

    ``base`` lists kind:start:end in code points, ``proposed`` start:kind:end:signature.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, proposed, counts = [], [], np.zeros((4, batch.num_rows), np.int64)
            for row, value in enumerate(batch.column(1)):
                text = value.as_py() or ""
                if not _ANY.search(text) and "at]" not in text and "at)" not in text:
                    base.append("")
                    proposed.append("")
                    continue
                spans = base_spans(text)
                for _, k, _ in spans:
                    counts[k, row] += 1
                base.append(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans))
                proposed.append(",".join(f"{a}:{k}:{b}:{s}" for a, k, b, s in proposals(text, spans)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c) for c in counts], pa.array(base), pa.array(proposed)],
                [id_col, *[f"n_{k}" for k in BASE_KINDS], "base", "proposed"])

    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    sums = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {id_type}, {sums}, base string, proposed string")


def _all_spans(base: str, proposed: str, accepted: dict[str, float]) -> str:
    spans = [(int(a), KINDS.index(k), int(b)) for k, a, b in (s.split(":") for s in base.split(",") if s)]
    own = []
    for part in proposed.split(",") if proposed else []:
        a, k, b, signature = part.split(":")
        if signature in accepted:
            own.append((-accepted[signature], int(a), int(k), int(b)))
    taken: list[tuple[int, int]] = []
    for _, a, k, b in sorted(own):
        if all(b <= x or y <= a for x, y in taken):
            taken.append((a, b))
            spans.append((a, k, b))
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base, spans) of every whole text.

    Offsets are code points, end exclusive; spans are sorted by start, then kind.  Base
    spans always stay; accepted proposals never overlap them or each other.  Null and
    empty texts have no spans; repeated rows stay repeated.
    """
    found = materialize(candidates(docs, id_col), "pii")
    signature = F.explode(F.filter(F.split("proposed", ","), lambda s: s != "")).alias("s")
    counts = found.select(signature).select(
        F.element_at(F.split("s", ":"), 4).alias("signature")).groupBy("signature").agg(
        F.count(F.lit(1)).alias("n")).toPandas()
    model = train(counts)
    signatures = list(counts["signature"]) if len(counts) else []
    accepted = {s: float(p) for s, p in zip(signatures, model.probability(signatures)) if p >= 0.5}

    @F.pandas_udf("string")
    def spans(base: pd.Series, proposed: pd.Series) -> pd.Series:
        return pd.Series([_all_spans(b, p, accepted) if p else b for b, p in zip(base, proposed)], dtype=object)

    return found.withColumn("spans", spans("base", "proposed")).drop("proposed")
