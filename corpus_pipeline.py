"""A pipeline from raw documents to token ids, made of five of the text operators.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns
of ``documents``; the last one returns what the encoded texts amount to. What a stage
returns is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import byte_bpe, mixing, near_copies, quality, simhash, suffix_dedup
from ledgerloom.llm.texts import small_batches
from ledgerloom.staging import stage

RANKS = "byte_bpe_multi_50k.tiktoken"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels beside the tables."""
    small_batches(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays; five-word shingles of 0.8 or more link documents."""
    small_batches(spark)
    return simhash.one_of_each(docs, near_copies.grouped)


def repeat_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Characters of long strings that stand earlier in the corpus go."""
    small_batches(spark)
    return suffix_dedup.remaining_texts(docs)


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents and parts of documents are taken until each source has its share."""
    small_batches(spark)
    return mixing.mixed_documents(docs)


def to_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded bytes of every taken text."""
    small_batches(spark)
    return byte_bpe.digests(byte_bpe.encode_documents(docs, public_tokenizers.path(RANKS)))


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", near_dedup),
    ("suffix-array dedup", repeat_dedup),
    ("mixing sources to target weights", to_weights),
    ("byte-level BPE encoding and decoding", to_ids),
]
# SQL can express neither the classifier nor the encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
