"""From raw documents to a training mix, one written table a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlake.llm import decontaminate, line_dedup, mixing, quality_classifier, simhash
from marketlake.session import materialize, use_utc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_classifier.accepted(docs, _table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go; so do documents that held nothing else."""
    return line_dedup.cleaned_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of SimHash near-duplicates stays."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or an edited copy of one, go."""
    return decontaminate.without_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, with the number of times each is read in ``mix_copies``."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_leaks),
    ("source_mixing", source_mix),
]

#: Trained scores, fingerprints and alignments have no SQL form; tests hold brute-force versions against them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each one reads what the one before has written."""
    use_utc(spark)
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
