"""The registered queries, and those with SQL against it."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as contract
from ledgerloom.llm.oracle import ORACLE
from ledgerloom.llm.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(contract.queries()) >= {*QUERIES, "pipeline"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    con = oracle.connect(SF_DIR)
    assert oracle.difference(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


COLUMNS = {
    "op1_substring_dedup": "doc_id n_words n_removed kept_sha256",
    "op2_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op3_hnsw_search": "query_id rank vec_id score",
    "op4_source_mixing": "doc_id size source_size target taken",
    "op5_url_filter": "page_id host path rule verdict",
    "op6_exact_topk": "query_id rank vec_id score",
    "op7_quality_classifier": "doc_id held_out score predicted",
    "op8_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op9_simhash_dedup": "doc_id fingerprint component_id",
    "op10_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op11_chat_format": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op12_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op13_hard_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
}
# Rows of those that do not give one for each row of a table; 50 queries are made ten hits each.
ROWS = {"op3_hnsw_search": 50, "op6_exact_topk": 50, "op11_chat_format": 21, "op12_prefix_trie": 47, "op13_hard_negatives": 150}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert df.columns == COLUMNS[name].split()
    rows = spark.read.parquet(f"{SF_DIR}/{'pages' if '_url_' in name else 'documents'}.parquet")
    assert df.count() == (ROWS.get(name) or rows.count())
