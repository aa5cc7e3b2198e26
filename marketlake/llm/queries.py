"""The operators of this folder as queries over the given tables, with SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import (
    decontaminate,
    divergence,
    licenses,
    line_dedup,
    merkle,
    mixing,
    pii,
    quality_classifier,
    quality_rules,
    simhash,
    suffix_dedup,
    toxicity,
    warc,
)
from marketlake.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op5_quality_rules")
def op5(spark, sf):
    return quality_rules.with_verdict(table(spark, sf, "documents"))


@query("op6_pii")
def op6(spark, sf):
    found = pii.find_personal_data(table(spark, sf, "documents"))
    return found.withColumn("base_sha256", F.sha2("base", 256)).drop("base")


@query("op8_simhash")
def op8(spark, sf):
    prints = simhash.fingerprints(table(spark, sf, "documents"), shingle=3)
    found = simhash.near_duplicates(prints, max_bits=2)
    return found.select("doc_id", simhash.to_hex(F.col("bits")).alias("fingerprint"), "component_id")


@query("op9_quality_classifier")
def op9(spark, sf):
    return quality_classifier.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op1_warc", warc.SQL)
def op1(spark, sf):
    return warc.archive_pages(table(spark, sf, "pages"), spark)


@query("op2_line_dedup", line_dedup.SQL)
def op2(spark, sf):
    found = line_dedup.deduplicate_lines(table(spark, sf, "documents"))
    return found.select("doc_id", "text", "lines_before", "lines_removed", "words_removed")


@query("op3_license_scan")
def op3(spark, sf):
    docs = table(spark, sf, "documents")
    return licenses.scan(docs, licenses.build_index(docs))


@query("op4_mix_sources", mixing.SQL)
def op4(spark, sf):
    return mixing.mix(table(spark, sf, "documents"))


@query("op7_toxicity")
def op7(spark, sf):
    return toxicity.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op10_decontaminate")
def op10(spark, sf):
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op11_merkle_manifest", merkle.SQL)
def op11(spark, sf):
    docs = table(spark, sf, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    given = merkle.tampered_leaf(docs, fields, changed="n_chars", key="doc_id")
    return merkle.manifest(docs, fields, group="lang", key="doc_id", given=given)


@query("op13_source_divergence", divergence.SQL)
def op13(spark, sf):
    return divergence.audit(table(spark, sf, "documents"))


@query("op12_suffix_dedup", suffix_dedup.SQL)
def op12(spark, sf):
    return suffix_dedup.deduplicate(table(spark, sf, "documents")).drop("spans")
