"""Groups of documents that exchange short keys instead of texts.

The two exact repeat finders work in rounds. Documents are dealt to groups of bounded size
by a hash of id and text. A group sends keys to buckets by their hash, each distinct key
once, so that a key which a third of all documents share arrives once a group, not once a
document. A bucket answers the groups that share a key. Answers meet their group's
documents again in the next round, where the group makes finer keys only where needed.
Every round's answers are written to the shared folder, and the shuffle files of the round
before are no longer needed then.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.texts import give_back
from ledgerloom.staging import stage

GROUP_BYTES = 2 << 20
GROUPS_A_BUCKET = 16
# A null id comes after all others.
LAST_ID = np.iinfo(np.int64).max
U64 = np.uint64
ANSWER, DOCUMENT = 0, 1


def text_key(text: Column) -> Column:
    """Tells texts of one id apart; null is empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def deal(docs: DataFrame, others: Sequence[str] = (), group_bytes: int = GROUP_BYTES) -> tuple[DataFrame, int]:
    """(g, doc_id, text_key, text, others) of every row, null texts as empty, and the number
    of buckets."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = size // group_bytes + 1
    text = F.coalesce("text", F.lit(""))
    carried = F.struct(*others).alias("others") if others else F.lit(None).cast("string").alias("others")
    named = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), text.alias("text"), carried)
    g = F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(groups)).cast("int")
    return named.withColumn("g", g), int(groups // GROUPS_A_BUCKET + 1)


def meet(dealt: DataFrame, answers: DataFrame | None, run: Callable, schema: str) -> DataFrame:
    """``run(g, answers, documents)`` for every group of documents.

    ``answers`` are rows of g and binary columns; ``run`` gets a list of bytes for each of
    them and the documents as an Arrow table, and yields record batches.
    """
    documents = dealt.select("g", F.lit(DOCUMENT).alias("kind"), "doc_id", "text_key", "text", "others")
    names = [c for c in answers.columns if c != "g"] if answers is not None else []
    if names:
        told = answers.select("g", F.lit(ANSWER).alias("kind"), *names)
        documents = documents.unionByName(told, allowMissingColumns=True)
    together = documents.repartition("g").sortWithinPartitions("g", "kind")

    def rounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, rows in runs_of(batches, "g"):
            kind = rows["kind"].to_numpy()
            cut = int(np.searchsorted(kind, DOCUMENT))
            said = {c: [x for x in rows[c][:cut].to_pylist()] for c in names}
            if cut < len(kind):
                yield from run(g, said, rows.slice(cut))
                give_back()

    return together.mapInArrow(rounds, schema)


def runs_of(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, pa.Table]]:
    """All rows of each value of a column by which the batches are sorted."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column)).to_numpy(zero_copy_only=False)
        if len(values) == 0:
            continue
        cuts = np.append(np.flatnonzero(np.diff(values, prepend=values[0] - 1)), len(values))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held and values[a] != now:
                yield now, pa.Table.from_batches(held)
                held = []
            now = int(values[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield now, pa.Table.from_batches(held)


def ids_of(documents: pa.Table) -> np.ndarray:
    return documents["doc_id"].combine_chunks().fill_null(LAST_ID).to_numpy(zero_copy_only=False)


def text_array(documents: pa.Table) -> pa.Array:
    column = documents["text"].combine_chunks()
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def by_bucket(hashes: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Where the keys of each bucket stand."""
    bucket = ((hashes >> U64(20)) % U64(n)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(n + 1))
    for i in range(n):
        if cuts[i] < cuts[i + 1]:
            yield i, order[cuts[i] : cuts[i + 1]]


def in_sorted(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values are in the sorted table."""
    if len(table) == 0:
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


def joined(parts: list[bytes], kind) -> np.ndarray:
    return np.frombuffer(b"".join(p for p in parts if p), kind)


KEYS = "bucket int, g int, once binary, often binary"


def key_rows(g: int, keys: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Distinct keys of a group for each bucket, those met once apart from those met often."""
    distinct, n = np.unique(keys, return_counts=True)
    rows = [
        (i, g, distinct[at][n[at] == 1].tobytes(), distinct[at][n[at] > 1].tobytes())
        for i, at in by_bucket(distinct, buckets)
    ]
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "g", "once", "often"])


def shared_keys(sent: DataFrame) -> DataFrame:
    """(g, shared): the keys of each group that are met more than once in all groups."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in runs_of(batches, "bucket"):
            groups = rows["g"].to_pylist()
            once = [np.frombuffer(x, U64) for x in rows["once"].to_pylist()]
            often = [np.frombuffer(x, U64) for x in rows["often"].to_pylist()]
            every = np.sort(np.concatenate(once + often + often))
            shared = np.unique(every[:-1][every[1:] == every[:-1]])
            told = [np.append(o[in_sorted(o, shared)], m).tobytes() for o, m in zip(once, often, strict=True)]
            yield pa.record_batch(
                [pa.array(groups, pa.int32()), pa.array(told, pa.binary())], names=["g", "shared"]
            )

    dealt = sent.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(answer, "g int, shared binary")


# Spark's setting to remove the shuffle files of a query when the query ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Stage a round's result; Spark removes the shuffle files behind it."""
    settings = df.sparkSession.conf
    before = settings.get(CLEAN_UP, "false")
    settings.set(CLEAN_UP, "true")
    try:
        return stage(df, name)
    finally:
        settings.set(CLEAN_UP, before)
