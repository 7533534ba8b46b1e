"""Files that keep arriving: each is ingested once, however often this runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerloom.sources.files import lenient, with_source_file


def ingest_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: StructType,
    fmt: str = "parquet",
    files_per_batch: int = 1000,
    **options: str,
) -> DataFrame:
    """Append the rows of all files not seen before and return the whole target.

    The checkpoint remembers the files taken and the target's log the batches
    committed, so a run that is cut off continues where it stopped and no file
    is stored twice. A large backlog is worked off in batches of
    ``files_per_batch`` files. Keep one checkpoint per target.
    """
    kept, read_schema = lenient(fmt, schema)
    arriving = (
        spark.readStream.format(fmt)
        .schema(read_schema)
        .options(**kept, **options)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source)
    )
    stamped = with_source_file(arriving)
    run = (
        stamped.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.schema(stamped.schema).parquet(target)
