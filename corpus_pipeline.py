"""The corpus pipeline: quality rules, near-duplicates, secrets, mixing, BPE."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tradewatch.llm import bpe, mixing, near_dups, quality, secrets
from tradewatch.session import shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the adaptive fences reject go."""
    return quality.kept_documents(docs)


def minhash_near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: five-word shingles, a similarity of 0.8 or more."""
    return near_dups.distinct_documents(docs, width=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is masked; no document goes."""
    return secrets.masked_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every visit of a document, in training order."""
    return mixing.training_stream(docs)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row's ids and of the text decoded from them."""
    return bpe.document_tokens(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dups", minhash_near_dups),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("bpe_encode", bpe_encode),
]
#: Shingle similarity, the random field and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    folder = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
