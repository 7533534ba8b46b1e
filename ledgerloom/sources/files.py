"""Tables and landed files."""

from __future__ import annotations

import re
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SOURCE_FILE = "source_file"
CORRUPT = "_corrupt_record"


def read_table(spark: SparkSession, where: str) -> DataFrame:
    """A catalog table by name, or Parquet files by path."""
    return spark.read.parquet(where) if "/" in where else spark.table(where)


def with_source_file(df: DataFrame) -> DataFrame:
    """Add the name of the file each row came from."""
    return df.select("*", F.col("_metadata.file_name").alias(SOURCE_FILE))


def lenient(fmt: str, schema: StructType | None) -> tuple[dict[str, str], StructType | None]:
    """Reader options that keep an unreadable line beside the good rows."""
    if fmt not in ("json", "csv"):
        return {}, schema
    if schema is None:
        raise ValueError(f"{fmt} files need an explicit schema")
    if CORRUPT not in schema.names:
        schema = StructType([*schema.fields]).add(CORRUPT, "string")
    return {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}, schema


def read_bronze(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | None = None,
    **options: str,
) -> DataFrame:
    """Landed files as they are, with the name of the source file.

    JSON and CSV need a schema, so that no pass over the files is spent on
    guessing one; lines that do not fit it are kept in ``_corrupt_record``.
    """
    kept, schema = lenient(fmt, schema)
    reader = spark.read.format(fmt).options(**kept, **options)
    if schema is not None:
        reader = reader.schema(schema)
    return with_source_file(reader.load(path))


def within(spark: SparkSession, folder: str) -> tuple[str, Column]:
    """The folder's full path, and a file's path within it from the column ``path``."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    full = system.makeQualified(where).toUri().getPath().rstrip("/") + "/"
    root = re.sub(r"\\(.)", r"\1", full)  # characters of patterns are given escaped
    begin = F.locate(root, F.col("path")) + len(root)
    return root, F.substring(F.col("path"), begin, F.length("path"))


def files_of(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """``name`` (the path within ``folder``) of every file, empty ones too.

    A scan passes over files without content, so the names come from the list that
    Spark makes before any scan.
    """
    root, _ = within(spark, folder)
    every = binary_files(spark, folder, pattern).inputFiles()
    names = [(unquote(urlsplit(f).path)[len(root) :],) for f in every]
    return spark.createDataFrame(names, "name string")


def binary_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(folder)
    )


def landing_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """What has landed: one row per file. Contents are not read.

    An empty file has ``n_bytes`` 0 and no time of change.
    """
    _, name = within(spark, folder)
    sized = binary_files(spark, folder, pattern).select(
        name.alias("name"), "length", F.col("modificationTime").alias("modified_at")
    )
    return files_of(spark, folder, pattern).join(sized, "name", "left").select(
        F.col("name").alias("path"),
        F.element_at(F.split("name", "/"), -1).alias("file_name"),
        F.coalesce("length", F.lit(0)).cast("bigint").alias("n_bytes"),
        "modified_at",
    )
