"""Corpus pipeline: stages over the documents table, each written as Parquet and read as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripleweave.llm import bpe, decontaminate, exact_dedup, minhash_dedup, toxicity
from tripleweave.llm.common import stage, table
from tripleweave.llm.queries import vocabulary_files


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity scorer does not reject; it learns from the labels of ``sf_dir`` and this stage's texts."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts the one with the largest id."""
    return exact_dedup.drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the row with the smallest id."""
    return minhash_dedup.drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not contaminated by the benchmark of ``sf_dir``."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts that are left, with digests of the ids and of the decoded text."""
    return bpe.bpe(docs, *vocabulary_files())


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("minhash_dedup", without_near_copies),
    ("decontaminate", without_benchmark),
    ("bpe", tokens),
]

#: Toxicity scores and token ids are beyond SQL; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
