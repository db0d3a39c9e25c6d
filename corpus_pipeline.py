"""Training-data pipeline: documents through the corpus operators, stage by stage.

Every stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet
in the shared folder and read again as the next stage's documents. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import decontaminate, ngram_join, packing, quality, secrets
from tallyspark.llm.common import read, ship_package, store


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the quality classifier selects."""
    return quality.select_good(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of every near-duplicate group."""
    return ngram_join.deduplicate(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents in which no benchmark item is found."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep every document, its secrets replaced by a mark."""
    return secrets.redact_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, with their places in the sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", good_documents),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", without_benchmark),
    ("secret_scan", without_secrets),
    ("best_fit_packing", packed),
]

#: Trained models, tokenizers and fingerprints are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``; the rows of the last."""
    ship_package(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
