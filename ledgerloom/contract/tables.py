"""Inputs shared by the registered queries."""

from __future__ import annotations

import atexit
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import BLANKS
from ledgerloom.operators.index import RulesIndex, build_index
from ledgerloom.operators.passages import chunk
from ledgerloom.plans.medallion import silver_of, to_gold, to_silver
from ledgerloom.session import configure
from ledgerloom.sources import documents_from_tables, read_table
from ledgerloom.staging import fresh_path

_indexes: dict[tuple[str, str], RulesIndex] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(*(table(spark, sf_dir, t) for t in ("orders", "customer", "nation")))


def silver_lookup(spark: SparkSession, sf_dir: str) -> Callable[[DataFrame], DataFrame]:
    return silver_of(*(table(spark, sf_dir, t) for t in ("orders", "customer", "nation")))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_gold(silver(spark, sf_dir))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_from_tables(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    )


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk(documents(spark, sf_dir))


# Stand-ins for the letters, of three scripts without blanks.
LETTERS = "abcdefghijklmnopqrstuvwxyz.,"
SIGNS = "あいうえおかきくけこアイウエオカキクケコ注文返品規則。、"


def without_blanks(text: Column) -> Column:
    """A text as if written in scripts without blanks."""
    return F.translate(F.regexp_replace(F.lower(text), BLANKS, ""), LETTERS, SIGNS)


def spaceless_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select("doc_id", without_blanks(F.col("text")).alias("text"))
    return chunk(texts)


def spaceless_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_questions(spark, sf_dir).withColumn("text", without_blanks(F.col("text")))


def stored_index(spark: SparkSession, sf_dir: str) -> RulesIndex:
    """The index over all documents, built once per session and data folder."""
    key = (spark.conf.get("spark.app.id"), sf_dir)
    if key not in _indexes:
        _indexes[key] = build_index(chunks(spark, sf_dir))
    return _indexes[key]


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What users said, with an order named in every other turn."""
    named = F.concat(
        F.lit(" ORD-"), (F.col("conv_id") * 37 + F.col("turn") * 11).cast("string")
    )
    return (
        table(spark, sf_dir, "conversations")
        .where(F.col("role") == "user")
        .select(
            F.concat_ws("-", "conv_id", "turn").alias("question_id"),
            F.concat(
                "text", F.when(F.col("turn") % 2 == 0, named).otherwise(F.lit(""))
            ).alias("text"),
        )
    )


def benchmark_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("question_id"), "text")


@contextmanager
def private_namespace(spark: SparkSession) -> Iterator[dict[str, str]]:
    """Arguments for a namespace nobody else uses, kept in the checkpoint folder;
    the session's current schema is put back afterwards, and the schema is dropped with
    the others when the program ends: what a query returns still reads it."""
    catalog, database = spark.catalog.currentCatalog(), spark.catalog.currentDatabase()
    prefix = f"handson_{uuid4().hex[:12]}_"
    _private.append(prefix)
    try:
        yield {"prefix": prefix, "location": fresh_path(spark, "schema")}
    finally:
        spark.sql(f"USE `{catalog}`.`{database}`")


_private: list[str] = []


def drop_private() -> None:
    """Drop all private schemas with their tables."""
    spark = SparkSession.getActiveSession()
    prefixes, _private[:] = tuple(_private), []
    if spark is None or not prefixes:
        return
    for row in spark.sql("SHOW SCHEMAS").collect():
        if row[0].startswith(prefixes):
            spark.sql(f"DROP SCHEMA `{row[0]}` CASCADE")


def _at_exit() -> None:
    try:
        drop_private()
    except Exception:  # noqa: BLE001 - the session may be gone already
        pass


atexit.register(_at_exit)


def flat(df: DataFrame, *money: str, to: str = "bigint") -> DataFrame:
    """Money columns as plain numbers, whose type both engines agree on."""
    return df.withColumns({c: F.col(c).cast(to) for c in money})
