"""A corpus pipeline over ``documents``: each stage's rows are written and read as the next one's input.

Language ID drops documents whose language cannot be told; SimHash near-dedup keeps one document of
each group; the secret scan takes secrets out of texts; mixing repeats or leaves out documents (or
parts) to the target weights; packing lays the texts into training sequences.  All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from strata.llm import lang_id, mixing, packing, secret_crf, simhash
from strata.llm.common import table
from strata.session import ensure_checkpoint_dir


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected are documents without a letter (null and empty texts too) and those whose language
    scores below ``lang_id.MIN_SCORE`` of the usual; without any labelled row to learn from, only the former."""
    return lang_id.with_language(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at 4 bits or fewer (4-word shingles) stays, that of the smallest id."""
    return simhash.keep_one(docs, words=4, max_bits=4)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in texts are replaced by a mark."""
    return secret_crf.redacted(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every time a document, or a part of it, is taken; documents without words go."""
    return mixing.mixed_documents(docs, weights=(3, 1, 2), share=1.5, cap=2)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts in sequences of at most 1024 ids."""
    return packing.packed_documents(docs, length=1024)


STAGES = [
    ("language_id", language_stage),
    ("simhash_near_dedup", simhash_stage),
    ("secret_scan", secret_stage),
    ("source_mix", mixing_stage),
    ("packing", packing_stage),
]

# Classifiers, SimHash and the tokenizer are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared checkpoint folder before the next."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
