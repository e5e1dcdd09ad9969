"""From raw documents to a training mix: five stages, each written as Parquet and read by the next.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before it kept. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sondelake.llm import decontam, langid, mixing, ngram_join, secret_scan
from sondelake.llm.queries import prepare, table
from sondelake.operators.scratch import write_scratch


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no letters, or no text) go."""
    prepare(spark)
    return langid.with_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a Jaccard similarity of 0.8 on five words, the smallest id stays."""
    prepare(spark)
    return ngram_join.one_of_each(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth of their words or more in benchmark passages go."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are masked."""
    prepare(spark)
    return secret_scan.without_secrets(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mixture", mixture),
]

#: Suffix automata, Viterbi and Markov chains have no SQL; tests compare with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_scratch(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
