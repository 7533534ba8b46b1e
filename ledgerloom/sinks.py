"""Writing tables: create once, replace, append new keys."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.staging import stage


def create_once(df: DataFrame, table: str, fmt: str = "parquet") -> DataFrame:
    """Create ``table`` from ``df``; if it exists, do nothing, whatever ``df`` is.

    ``df`` is not even planned when the table exists, so a re-run is cheap. A
    changed query is therefore ignored too: use :func:`replace_table` to refresh.
    """
    df.write.mode("ignore").format(fmt).saveAsTable(table)
    return df.sparkSession.table(table)


def replace_table(
    df: DataFrame,
    table: str,
    fmt: str = "parquet",
    by: Sequence[str] = (),
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Create ``table`` from ``df`` or replace its rows and schema.

    The table lies in folders by the columns ``by``; its writer gets the ``options``. ``df`` may read the table it replaces: only then is it staged first.
    """
    options = options or {}
    try:
        df.write.mode("overwrite").partitionBy(*by).format(fmt).options(**options).saveAsTable(table)
    except AnalysisException as error:
        if not (error.getCondition() or "").startswith("UNSUPPORTED_OVERWRITE"):
            raise
        staged = stage(df, "replace")
        staged.write.mode("overwrite").partitionBy(*by).format(fmt).options(**options).saveAsTable(table)
    return df.sparkSession.table(table)


# Partition columns of a table that is filled by batches.
STREAM, BATCH = "_stream", "_batch"


def write_batch(df: DataFrame, table: str, stream: str, number: int, fmt: str = "parquet") -> None:
    """Store the rows of batch ``number`` of ``stream``, and only them, under that number.

    What is there of the same batch is replaced, so a batch that is written again, because
    the run ended before it was known to be written, stores nothing twice. The table is
    created if missing. Columns it lacks are added to it; columns the batch lacks are null.
    """
    spark = df.sparkSession
    stamped = df.withColumns({STREAM: F.lit(stream), BATCH: F.lit(number).cast("long")})
    if not spark.catalog.tableExists(table):
        stamped.limit(0).write.format(fmt).partitionBy(STREAM, BATCH).mode("ignore").saveAsTable(table)
    have = spark.table(table).columns
    new = [f for f in df.schema.fields if f.name not in have]
    if new:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
    target = [f for f in spark.table(table).schema.fields if f.name not in (STREAM, BATCH)]
    rows = df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target
        ]
    )
    named = stream.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({STREAM} = '{named}', {BATCH} = {number}) SELECT * FROM {{rows}}",
        rows=rows,
    )


def version_name(name: str, version: str) -> str:
    closing = "`" if name.endswith("`") else ""
    return f"{name.removesuffix(closing)}__v{version}{closing}"


def versions(spark: SparkSession, name: str) -> list[tuple[int, str]]:
    """Stored versions of a published table, oldest first: number and table name."""
    space, _, last = name.rpartition(".")
    stem = f"{last.strip('`').lower()}__v"
    shown = spark.sql(f"SHOW TABLES {f'IN {space}' if space else ''} LIKE '{stem}*'").collect()
    endings = [row["tableName"].lower().removeprefix(stem) for row in shown]
    return sorted((int(e.split("_")[0]), version_name(name, e)) for e in endings)


def publish(df: DataFrame, name: str, fmt: str = "parquet", keep: int = 2) -> DataFrame:
    """Make ``df`` what readers of ``name`` find, without a moment in between.

    Rows are written to a table of their own; then ``name``, a view, is pointed to it in one
    change of the catalog. A reader finds the old rows or the new, never none or a mixture,
    and what was opened before goes on reading the old table until it is dropped: the
    ``keep`` newest versions stay. A write that fails changes nothing for readers. ``df`` may
    read ``name``. Rows and schema may both change. Of two writers the last to end wins.
    """
    spark = df.sparkSession
    number = max((n for n, _ in versions(spark, name)), default=0) + 1
    target = version_name(name, f"{number:08d}_{uuid4().hex[:8]}")
    df.write.format(fmt).saveAsTable(target)
    # Altering a view is one change; replacing it would drop it first.
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER VIEW {name} AS SELECT * FROM {target}")
    else:
        spark.sql(f"CREATE VIEW {name} AS SELECT * FROM {target}")
    older = [table for n, table in versions(spark, name) if n <= number and table != target]
    for table in older[: max(0, len(older) + 1 - max(keep, 1))]:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return spark.table(name)


def replace_view(spark: SparkSession, view: str, query: str) -> DataFrame:
    """Create or replace a catalog view."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {query}")
    return spark.table(view)


def append_new(batch: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Append the rows of ``batch`` whose key ``table`` does not hold yet.

    Repeats of a key inside the batch are stored once (the smallest row), and
    sending a batch again stores nothing. Returns the rows that were appended.
    Rows without a full key cannot be recognised again and are refused.

    The table is only read: its key columns are semi-joined with the batch's
    keys, so that what is compared afterwards is no larger than the batch and
    the whole table is never shuffled when the batch is small. The new rows are
    staged before the insert, which never reads what it writes. Parquet has no
    transactions: let one writer at a time append to a table.
    """
    spark = batch.sparkSession
    keys = list(keys)
    columns = spark.table(table).columns
    others = [c for c in columns if c not in keys]
    checked = batch.select(
        *[
            F.when(F.col(k).isNotNull(), F.col(k))
            .otherwise(F.raise_error(F.lit(f"null key column {k}")))
            .alias(k)
            for k in keys
        ],
        *others,
    )
    once = checked.groupBy(*keys).agg(F.min(F.struct(*others)).alias("row")) if others else (
        checked.distinct()
    )
    arrived = stage(once.select(*keys, "row.*") if others else once, "arrived")
    seen = spark.table(table).select(*keys).join(arrived.select(*keys), keys, "left_semi")
    fresh = stage(arrived.join(seen, keys, "left_anti").select(*columns), "fresh")
    fresh.write.insertInto(table)
    return fresh
