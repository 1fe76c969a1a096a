"""Cleaning a text corpus in stages; each stage works on all its predecessor kept.

Quality, one document of each near-duplicate class, no benchmark passages, no personal
data, then token ids. All stages but the last return the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from assayline.llm import pii, quality
from assayline.llm.bpe_tree import encode_documents
from assayline.llm.decontaminate import remove_leaks
from assayline.llm.near_dedup import keep_one
from assayline.llm.tables import ship, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, does not reject."""
    ship(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near-duplicates."""
    ship(spark)
    return keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no benchmark item."""
    ship(spark)
    return remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; personal data in their texts is replaced."""
    ship(spark)
    return pii.sanitise(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and decoded text of every document that is left."""
    ship(spark)
    return encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", good_quality),
    ("near_dedup", one_of_each),
    ("decontamination", decontaminated),
    ("pii", without_personal_data),
    ("bpe", encoded),
]

# SQL has none of boosted tables, signatures and merges: tested against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
