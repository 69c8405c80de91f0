"""Pipeline over ``documents``: quality classifier, SimHash near-dedup,
benchmark decontamination, PII, best-fit packing.

Each stage takes (spark, docs, sf_dir); its rows are written as Parquet and
read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusforge.llm import decontam, packing, pii, quality, simhash
from corpusforge.llm.common import staged, table
from corpusforge.llm.queries import tokenizer


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts 1."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.keep_one(docs, shingle=3, bits=2)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in the sequences."""
    return packing.pack(docs, tokenizer(), capacity=2048)


STAGES = [
    ("quality_classifier", good),
    ("simhash_near_dedup", distinct),
    ("benchmark_decontamination", unleaked),
    ("pii", redacted),
    ("best_fit_packing", packed),
]

#: SQL can't express the classifier, XXH64, tiling or the tokenizer; the tests
#: compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
