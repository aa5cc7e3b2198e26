"""Multi-word terms in texts: a token trie as a table, the longest match from the left, synonyms merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators.graph import components

#: ASCII white space and punctuation part words.
SEPARATORS = "\t\n\x0b\x0c\r!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """Words with A-Z lowered; null text has none."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER + SEPARATORS, _UPPER.lower() + " " * len(SEPARATORS))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def merged_terms(terms: DataFrame, synonyms: DataFrame) -> DataFrame:
    """(term, skill): every term of ``terms`` (term) with the smallest of its synonyms (a, b)."""
    root = components(synonyms).select(F.col("node").alias("term"), "label")
    return terms.select("term").distinct().join(root, "term", "left").select(
        "term", F.coalesce("label", "term").alias("skill"))


def trie(dictionary: DataFrame) -> DataFrame:
    """(parent, token, node, depth, skill): a row a node; ``skill`` is null where no term ends.

    A node is named by its words, its parent by all but the last; terms without words are left out.
    """
    tokens = dictionary.select(words(F.col("term")).alias("tokens"), "skill").filter(F.size("tokens") > 0)
    step = F.explode(F.sequence(F.lit(1), F.size("tokens")))
    nodes = tokens.select("tokens", "skill", step.alias("depth")).select(
        F.array_join(F.slice("tokens", 1, F.col("depth") - 1), " ").alias("parent"),
        F.element_at("tokens", F.col("depth")).alias("token"),
        F.array_join(F.slice("tokens", 1, F.col("depth")), " ").alias("node"), "depth",
        F.when(F.col("depth") == F.size("tokens"), F.col("skill")).alias("skill"))
    return nodes.groupBy("parent", "token", "node", "depth").agg(F.min("skill").alias("skill"))


def term_places(docs: DataFrame, nodes: DataFrame, depth: int, key: str, text: str) -> DataFrame:
    """(key, start, size, skill): the longest term from every word on, counted from 0.

    ``nodes`` is a written trie of at most ``depth`` levels.  Every word begins a walk; each
    level is one equality join with the trie.  A walk needs its first word, and then ends
    where the trie has no such word.
    """
    some = docs.select(F.col(key).alias("key"), words(F.col(text)).alias("words")).filter(F.size("words") > 0)
    ahead = F.transform(F.sequence(F.lit(1), F.size("words")), lambda i: F.slice(F.col("words"), i, depth))
    walks = some.select("key", F.posexplode(ahead).alias("start", "ahead")).withColumn("at", F.lit(""))
    for level in range(1, depth + 1):
        here = nodes.filter(F.col("depth") == level).select(
            F.col("parent").alias("at"), "token", F.col("node").alias("to"), F.col("skill").alias(f"skill{level}"))
        walks = walks.withColumn("token", F.get("ahead", F.lit(level - 1))).join(
            here, ["at", "token"], "inner" if level == 1 else "left").withColumn("at", F.col("to")).drop("to")
    ends = [F.when(F.col(f"skill{k}").isNotNull(), F.struct(F.lit(k).alias("size"), F.col(f"skill{k}").alias("skill")))
            for k in range(depth, 0, -1)]
    longest = walks.select("key", "start", F.coalesce(*ends).alias("best")).filter("best is not null")
    return longest.select("key", "start", F.col("best.size").alias("size"), F.col("best.skill").alias("skill"))


def _without_overlaps(places: Column) -> Column:
    """Places (start, size, skill) in order, each that begins before the last one's end left out."""
    empty = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<start:int,size:int,skill:string>>").alias("kept"))
    return F.aggregate(F.array_sort(places), empty, lambda state, p: F.when(
        p["start"] < state["end"], state).otherwise(F.struct(
            (p["start"] + p["size"]).alias("end"), F.concat(state["kept"], F.array(p)).alias("kept"))),
        lambda state: state["kept"])


def extract_terms(docs: DataFrame, nodes: DataFrame, depth: int, key: str, text: str) -> DataFrame:
    """(key, start, size, skill): terms of every text; the leftmost wins, then the longest, none overlap.

    ``key`` is unique; texts without terms give no rows.
    """
    places = term_places(docs, nodes, depth, key, text)
    kept = places.groupBy("key").agg(_without_overlaps(F.collect_list(F.struct("start", "size", "skill"))).alias("kept"))
    return kept.select(F.col("key").alias(key), F.inline("kept"))
