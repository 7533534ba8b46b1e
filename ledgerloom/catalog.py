"""The lookups as SQL functions over a namespace's tables.

They serve one key or one question at a time from SQL; for many, use the
DataFrame functions of the same names.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerloom.functions.scripts import TERM
from ledgerloom.operators.index import B, BUCKETS, K1, NAMES
from ledgerloom.operators.ranking import STEPS
from ledgerloom.session import Namespace

# Parts ranked on their own first, so that the final ranking sees no more than
# this many times k rows.
PARTS = 512


def install_order_lookup(spark: SparkSession, ns: Namespace) -> None:
    """``search_order_info(order_id)``: the order's Silver row, or none."""
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION search_order_info(wanted BIGINT)
        RETURNS TABLE (
          order_id BIGINT, order_date DATE, order_priority STRING,
          order_amount DECIMAL(18,2), customer_name STRING, market_segment STRING,
          nation STRING
        )
        RETURN SELECT order_id, order_date, order_priority, order_amount, customer_name,
                      market_segment, nation
               FROM {ns.table("orders_silver")} WHERE order_id = wanted
        """
    )


def install_rule_search(spark: SparkSession, ns: Namespace) -> None:
    """``search_rules(question, k)``: the ``k`` best passages of the saved index.

    The terms of one question and its ``k`` passages are few, which Spark can't tell from the
    sizes of the tables they are looked up in. It is told, or it would shuffle the whole index
    as soon as the vocabulary is too large to be sent to all tasks.
    """
    table = {part: ns.table(name) for part, name in NAMES.items()}
    pattern = TERM.replace("\\", "\\\\")
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION search_rules(question STRING, k INT)
        RETURNS TABLE (rank INT, chunk_id STRING, score DOUBLE, text STRING)
        RETURN
          WITH wanted AS (
            SELECT DISTINCT explode(regexp_extract_all(lower(question), '{pattern}', 1)) AS term
          ), asked AS (
            SELECT /*+ BROADCAST(a) */ a.term, pmod(xxhash64(a.term), {BUCKETS}) AS bucket, v.df,
                   (SELECT n_passages FROM {table["corpus"]}) AS n_passages,
                   (SELECT mean_terms FROM {table["corpus"]}) AS mean_terms
            FROM wanted a JOIN {table["vocabulary"]} v ON v.term = a.term
          ), scored AS (
            SELECT p.chunk_id, sum(cast(floor((cast(floor(w.idf * (p.tf * {K1 + 1}D
                     / (p.tf + {K1}D * ({1 - B}D + {B}D * p.n_terms / w.mean_terms)))
                     * 1e12D + 0.5D) AS DOUBLE) + 500000D) / 1000000D) AS BIGINT))
                   / {STEPS}D AS score
            FROM (SELECT /*+ BROADCAST(a) */ a.mean_terms, b.items,
                         ln(1 + (a.n_passages - a.df + 0.5D) / (a.df + 0.5D)) AS idf
                  FROM asked a
                  JOIN {table["blocks"]} b ON b.bucket = a.bucket AND b.term = a.term) w,
                 LATERAL inline(w.items) AS p
            GROUP BY p.chunk_id HAVING score > 0
          ), leading AS (
            SELECT chunk_id, score, row_number() OVER (
                     PARTITION BY pmod(xxhash64(chunk_id), {PARTS})
                     ORDER BY score DESC, chunk_id) AS place
            FROM scored
          ), ranked AS (
            SELECT chunk_id, score,
                   row_number() OVER (ORDER BY score DESC, chunk_id) AS rank
            FROM leading WHERE place <= k
          )
          SELECT /*+ BROADCAST(r) */ r.rank, r.chunk_id, r.score, t.text
          FROM ranked r JOIN {table["passages"]} t ON t.chunk_id = r.chunk_id
          WHERE r.rank <= k
        """
    )
