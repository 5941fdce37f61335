"""The documents table cleaned for training: each stage works on what the one before kept.

All stages but the last return the columns of their input. ``run`` writes every stage's rows as
Parquet to the shared folder and reads them back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyflow.llm import bpe, decontaminate, pii, simhash, toxicity
from skyflow.llm.common import table
from skyflow.llm.queries import tokenizer_path
from skyflow.plans.staging import staged


def _counted(docs: DataFrame) -> DataFrame:
    """``docs`` with the number of characters of its changed texts, if it has that column."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic; learned from the labels outside the held-out fold."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, benchmark passages cut out of their texts."""
    return _counted(decontaminate.remove_passages(docs, table(spark, sf_dir, "benchmark")))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return _counted(pii.redact(docs, pii.fit(docs)))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Numbers and digests of the documents' tokens, and of the text decoded from them."""
    return bpe.digests(docs, tokenizer_path())


STAGES = [
    ("toxicity", without_toxic),
    ("simhash_near_dedup", without_near_duplicates),
    ("benchmark_decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("bpe", tokenized),
]

#: Models and fingerprints are not expressible in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage for the documents in ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
