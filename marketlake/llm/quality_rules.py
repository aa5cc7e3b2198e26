"""Quality rules as a bitmask ledger.

Every rule is evaluated once a document; the ledger keeps the measurements and one
failure bit a rule.  Policies are versioned masks over those bits, so a new policy, or
what each rule removes on its own, is bitwise work over the ledger and never reads a
text again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.document_stats import SCHEMA, STATS, measure
from marketlake.llm.text import map_chunks

_C = F.col


def _over(part: str, whole: str, percent: int) -> Column:
    return 100 * _C(part) > percent * _C(whole)



def _rules() -> dict[str, Column]:
    """Rule -> condition under which a document fails it; bit k belongs to the k-th name
    of ``RULE_NAMES``, which is only ever appended to, so older ledgers keep their meaning.
    """
    return {
        "few_words": _C("n_words") < 10,
        "repeated_windows": _over("n_repeat_words", "n_words", 20),
        "symbols": _over("n_symbols", "n_words", 30),
        "duplicate_lines": _over("n_dup_lines", "n_lines", 40),
        "capitals": _C("n_upper") > _C("n_lower"),
        "shouts": _over("n_shouts", "n_words", 30),
        "bare_symbols": _over("n_bare_symbols", "n_words", 15),
        "one_word": (_C("n_words") >= 10) & _over("n_top_word", "n_words", 30),
        "word_length": (_C("word_chars") < 2 * _C("n_words"))
        | (_C("word_chars") > 20 * _C("n_words")),
        "echoes": (_C("n_words") >= 10) & _over("n_echoes", "n_words", 30),
    }


RULE_NAMES = ["few_words", "repeated_windows", "symbols", "duplicate_lines", "capitals", "shouts",
              "bare_symbols", "one_word", "word_length", "echoes"]
#: Policy version -> rules that reject a document.
POLICIES = {
    "base": ["few_words", "repeated_windows"],
    "v1": ["few_words", "repeated_windows", "symbols", "capitals", "bare_symbols"],
    "v2": list(RULE_NAMES),
}


def mask(names: list[str]) -> int:
    return sum(1 << RULE_NAMES.index(n) for n in names)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, every measurement, ``fail_bits``), one row a row of ``docs``.

    A null or empty text has no words and fails ``few_words``.  Repeated rows give
    repeated ledger rows; other columns of ``docs`` are not read.
    """
    measured = map_chunks(docs, [id_col], text_col, measure, SCHEMA)
    bits = F.lit(0).cast("long")
    rules = _rules()
    for k, name in enumerate(RULE_NAMES):
        failed = F.coalesce(rules[name], F.lit(False))
        bits = bits.bitwiseOR(F.when(failed, F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")))
    return measured.withColumn("fail_bits", bits)


def apply_policy(rows: DataFrame, policy: str) -> DataFrame:
    """Add ``kept``: no rule of the policy failed."""
    return rows.withColumn("kept", _C("fail_bits").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0)


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """(rule, failed, rejected_alone): rows failing each rule, and those it alone rejects.

    One pass with a bit count; without the rule, ``rejected_alone`` rows would be kept.
    """
    inside = _C("fail_bits").bitwiseAND(F.lit(mask(POLICIES[policy])))
    names = POLICIES[policy]
    sums = []
    for name in names:
        bit = 1 << RULE_NAMES.index(name)
        sums.append(F.count_if(inside.bitwiseAND(F.lit(bit)) != 0).alias(f"{name}_failed"))
        sums.append(F.count_if(inside == bit).alias(f"{name}_alone"))
    stack = ", ".join(f"'{n}', {n}_failed, {n}_alone" for n in names)
    return rows.agg(*sums).selectExpr(f"stack({len(names)}, {stack}) as (rule, failed, rejected_alone)")


def with_verdict(docs: DataFrame, policy: str = "v2") -> DataFrame:
    """The ledger with the policy's verdict; ``base_failed`` tells the two base rules."""
    rows = apply_policy(ledger(docs), policy)
    base = _C("fail_bits").bitwiseAND(F.lit(mask(POLICIES["base"]))) != 0
    return rows.withColumn("base_failed", base).withColumn("kept", ~base & _C("kept")).select(
        "doc_id", *STATS, "fail_bits", "base_failed", "kept"
    )
