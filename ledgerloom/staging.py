"""Written intermediate results.

``stage`` cuts lineage by writing a table to the shared checkpoint folder, so
that a lost executor costs a re-read and not a recomputation, and a frame used
several times is computed once. What was staged is dropped when the program ends,
or by :func:`drop_staged`.
"""

from __future__ import annotations

import atexit
import tempfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

# How large tables of texts and postings are written. Strings that come again are listed once
# in a file, in a dictionary of up to 16 MB.
SMALL = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "6",
    "parquet.dictionary.page.size": str(16 << 20),
}
# Drops the shuffle files of a plan when it has run.
DROPS_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folders: dict[str, str] = {}
_made: list[str] = []


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session whose master is known to be local gets a temporary folder; on
    a cluster the setting's absence is an error, as executors share no local disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="ledgerloom-")
    return _local_folders[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the checkpoint folder that no other run uses."""
    path = f"{checkpoint_folder(spark)}/{name}-{uuid4().hex}"
    _made.append(path)
    return path


def stage(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write ``df`` once, in folders by the columns ``by``, and return a scan of it."""
    return stage_all([df], name, *by)


def stage_small(df: DataFrame, name: str, *by: str) -> DataFrame:
    """The same in fewer bytes, for large tables."""
    return stage_all([df], name, *by, options=SMALL)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written in this block leaves no shuffle files behind.

    They stay otherwise until the driver happens to collect its garbage. Nothing that is
    not yet written should be read twice in it: it would be shuffled again.
    """
    before = spark.conf.get(DROPS_SHUFFLES)
    spark.conf.set(DROPS_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROPS_SHUFFLES, before)


def stage_all(
    frames: Iterable[DataFrame], name: str, *by: str, options: dict[str, str] | None = None
) -> DataFrame:
    """Write frames of one schema into one table, one after the other.

    ``frames`` may be a generator: the next frame is made when the last is written,
    so the driver holds one at a time.
    """
    path, first = None, None
    for df in frames:
        if first is None:
            first, path = df, fresh_path(df.sparkSession, name)
        df.write.mode("append").partitionBy(*by).options(**options or {}).parquet(path)
    if first is None:
        raise ValueError("nothing to stage")
    return first.sparkSession.read.schema(first.schema).parquet(path)


def drop_staged() -> None:
    """Remove everything staged so far; frames that read it can't be used any more."""
    jvm = SparkContext._jvm
    paths, _made[:] = list(_made), []
    if jvm is None:
        return
    settings = jvm.org.apache.hadoop.conf.Configuration()
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(settings).delete(where, True)


def _at_exit() -> None:
    try:
        drop_staged()
    except Exception:  # noqa: BLE001 - the JVM may be gone already
        pass


atexit.register(_at_exit)
