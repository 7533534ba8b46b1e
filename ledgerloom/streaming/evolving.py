"""Files that keep arriving, with columns nobody declared, stored exactly once in a table."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerloom.sinks import BATCH, STREAM, write_batch
from ledgerloom.sources.files import SOURCE_FILE

RESCUED = "_rescued"
OWN = (RESCUED, SOURCE_FILE, STREAM, BATCH)


class SchemaLog:
    """The columns known so far, a small table per change, in the folder of a checkpoint."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark, self.folder = spark, f"{checkpoint.rstrip('/')}/columns"

    def entries(self) -> list[int]:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/*/_SUCCESS")
        system = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(int(f.getPath().getParent().getName()) for f in system.globStatus(where) or [])

    def known(self) -> StructType | None:
        numbers = self.entries()
        if not numbers:
            return None
        row = self.spark.read.schema("columns string").parquet(f"{self.folder}/{numbers[-1]}").first()
        return StructType.fromJson(json.loads(row["columns"]))

    def note(self, columns: StructType) -> None:
        number = (self.entries() or [0])[-1] + 1
        row = self.spark.createDataFrame([(columns.json(),)], "columns string")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/{number}")


def ingest_evolving(
    spark: SparkSession,
    source: str,
    table: str,
    checkpoint: str,
    fmt: str = "parquet",
    files_per_batch: int = 1000,
) -> DataFrame:
    """Append the rows of all files of ``source`` not seen before to ``table``, and return it
    as :func:`read_evolving` does. Parquet and JSON files.

    No schema is given. The first batch's columns are noted beside the checkpoint. A column
    that is not noted yet is not lost: its values go to ``_rescued``, a VARIANT of what the
    noted columns lack, and it is noted for the next start, from which on it is a column of
    the table. A column that a file lacks is null. A noted column whose values no longer fit
    its type stops the run, and nothing of that batch is stored.

    The stream itself carries the names of new files only; each batch reads its own, at most
    ``files_per_batch``, with all columns they have. A batch is written as partitions of its
    own, under the checkpoint's name and the batch's number: a run that was cut off between
    writing and committing writes the same partitions again. So each row is stored once,
    whatever kind of table it is, and several streams may fill one table.
    """
    log = SchemaLog(spark, checkpoint)
    columns = log.known()
    stream = checkpoint.rstrip("/").rsplit("/", 1)[-1]

    def store(names: DataFrame, number: int) -> None:
        nonlocal columns
        files = [r[0] for r in names.select("file").distinct().collect()]
        if not files:
            return
        rows = spark.read.option("mergeSchema", "true").format(fmt).load(files)
        found = StructType([f for f in rows.schema.fields if f.name not in OWN])
        if columns is None:
            log.note(found)
            columns = found
        known = set(columns.names)
        further = [f for f in found.fields if f.name not in known]
        there = set(found.names)
        kept = [
            (F.col(f"`{f.name}`").cast(f.dataType) if f.name in there else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in columns.fields
        ]
        name = F.col("_metadata.file_name").alias(SOURCE_FILE)
        write_batch(rows.select(*kept, rescued(further), name), table, stream, number)
        if further:
            log.note(StructType([*columns.fields, *[StructField(f.name, f.dataType) for f in further]]))

    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source)
        .select(F.col("path").alias("file"))
    )
    run = files.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
    return read_evolving(spark, table, log.known() or StructType())


def rescued(further: list[StructField]) -> Column:
    """What the known columns lack, as one object; null where there is nothing."""
    if not further:
        return F.lit(None).cast("variant").alias(RESCUED)
    names = [F.col(f"`{f.name}`") for f in further]
    some = reduce(Column.__or__, [c.isNotNull() for c in names])
    return F.when(some, F.to_variant_object(F.struct(*names))).alias(RESCUED)


def read_evolving(spark: SparkSession, table: str, columns: StructType) -> DataFrame:
    """The table with all noted columns, empty if nothing was stored yet; values that were rescued before a column was noted
    stand in it."""
    if not spark.catalog.tableExists(table):
        return spark.createDataFrame([], StructType([*columns.fields, StructField(SOURCE_FILE, StringType())]))
    stored = spark.table(table)
    have = set(stored.columns)

    def filled(f: StructField) -> Column:
        path = "$['" + f.name.replace("'", "\\'") + "']"
        saved = F.try_variant_get(RESCUED, path, f.dataType.simpleString())
        return (F.coalesce(F.col(f"`{f.name}`"), saved) if f.name in have else saved).alias(f.name)

    return stored.select(*[filled(f) for f in columns.fields], SOURCE_FILE)
