"""Corpus pipeline: documents in, a deduplicated, mixed and tokenised training set out.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before
it kept, and returns a DataFrame; all but the last return the columns of
``documents``.  `run` writes each stage's result as Parquet to the session's
shared checkpoint folder and rereads it as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlens.llm import exact_dedup, mixing, sentencepiece_codec, simhash, toxicity
from eventlens.session import scratch_path


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the CRF doesn't call toxic (operator 2)."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays (operator 9)."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash neighbours stays (operator 8)."""
    return simhash.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (operator 6)."""
    return mixing.mix(docs)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids in place of their texts (operator 4)."""
    return sentencepiece_codec.encode(docs)


STAGES = [
    ("toxicity", not_toxic),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("mixing", mixed),
    ("SentencePiece encoding", tokenised),
]

#: SQL has neither the classifier of the first stage nor XXH64 or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
