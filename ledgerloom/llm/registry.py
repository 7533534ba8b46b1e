"""The registered queries of this package: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    byte_bpe,
    chat,
    hard_negatives,
    hnsw,
    mixing,
    prefix_trie,
    quality,
    recompression,
    simhash,
    suffix_dedup,
    token_counts,
    url_rules,
    voronoi,
)
from ledgerloom.llm.texts import small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_substring_dedup(spark, sf_dir):
    return recompression.digests(table(spark, sf_dir, "documents"))


@query
def op2_token_counts(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path, 512)


@query
def op3_hnsw_search(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    asked = vectors.where(F.col("vec_id") % 100 == 0)
    return hnsw.nearest(vectors, asked.withColumnRenamed("vec_id", "query_id"), 10)


@query
def op4_source_mixing(spark, sf_dir):
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


@query
def op5_url_filter(spark, sf_dir):
    return url_rules.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@query
def op6_exact_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    asked = vectors.where(F.col("vec_id") % 100 == 0)
    return voronoi.top_k(vectors, asked.withColumnRenamed("vec_id", "query_id"), 10, 1024)


@query
def op7_quality_classifier(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_suffix_dedup(spark, sf_dir):
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


@query
def op9_simhash_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op10_byte_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(byte_bpe.encode_documents(table(spark, sf_dir, "documents"), path))


@query
def op11_chat_format(spark, sf_dir):
    said = chat.with_awkward(table(spark, sf_dir, "conversations"))
    return chat.digests(chat.format_conversations(said))


@query
def op12_prefix_trie(spark, sf_dir):
    turns = prefix_trie.numbered(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.rebuilt(turns)).drop("node")


@query
def op13_hard_negatives(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), F.col("embedding").alias("vector"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0)
