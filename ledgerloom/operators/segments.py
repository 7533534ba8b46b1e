"""An index that grows: segments that are never changed, and marks of what was removed.

Every addition becomes a segment, an index of its own. Removing documents writes a table of
marks: their ids, which hold for the segments there were at that time. Adding a document
anew removes its earlier passages first. A version is a small table that lists segments and
marks; it is written last, so a reader sees the version before or after a change and none
in between, and what a reader has opened stays as it was. One writer at a time.

A version is searched like any index. Numbers that depend on the whole - passages, their
mean length, in how many a term occurs - are added up from the segments, less what marks
take away, so scores are those of an index built afresh from what is there. What a term
gives at most was written with an earlier mean; it is raised by as much as a longer mean can
raise it.

Segments of like size are merged when there are ``FAN`` of them, and one by itself when
most of it is removed. A merged segment is made from counted passages, not from texts, and
without the removed ones. So each passage is rewritten a number of times that grows with the
logarithm of the index, and large segments rest.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.index import RulesIndex, in_places, index_measured, measure_passages, part_of
from ledgerloom.staging import SMALL, stage

FAN = 4
# A segment with a larger share of removed passages is rewritten.
MOST_REMOVED = 0.5
VERSION = "kind string, name string, n_passages long, n_removed long, since int"
PARTS = ("passages", "blocks", "vocabulary", "corpus")
# Begins the names of segments whose parts are ranges of places; parts of older ones are remainders.
PLACED = "placed-"


@dataclass(frozen=True)
class Segment:
    """``since`` is the version it came with: only marks of later versions hold for it."""

    name: str
    n_passages: int
    n_removed: int
    since: int


class GrowingIndex:
    """The index in the folder ``root``, which all executors must reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def version(self) -> int:
        """Number of the last version that was written whole; 0 if there is none."""
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/version-*/_SUCCESS")
        system = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = [str(f.getPath().getParent().getName()) for f in system.globStatus(where) or []]
        return max((int(name.split("-")[1]) for name in found), default=0)

    def listed(self, version: int | None = None) -> tuple[list[Segment], list[tuple[str, int]]]:
        """Segments and marks of a version; marks with the version they came with."""
        version = self.version() if version is None else version
        if version == 0:
            return [], []
        rows = self.spark.read.schema(VERSION).parquet(self.path(f"version-{version}")).collect()
        segments = [Segment(r["name"], r["n_passages"], r["n_removed"], r["since"]) for r in rows if r["kind"] == "segment"]
        return segments, [(r["name"], r["since"]) for r in rows if r["kind"] == "marks"]

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def add(self, chunks: DataFrame) -> None:
        """Add passages ``(doc_id, chunk_no, chunk_id, text)``; documents that are there
        already are replaced as a whole."""
        segments, marks = self.listed()
        now = self.version() + 1
        chunks = stage(chunks, "added")
        if segments:
            segments, marks = self.marked(segments, marks, chunks.select("doc_id").distinct(), now)
        segments.append(self.written(measure_passages(in_places(chunks)), now))
        self.settle(segments, marks, now)

    def remove(self, doc_ids: DataFrame) -> None:
        """Remove the documents of a table of ``doc_id``; unknown ones are passed over."""
        segments, marks = self.listed()
        now = self.version() + 1
        self.settle(*self.marked(segments, marks, doc_ids.select("doc_id").distinct(), now), now)

    def marked(self, segments, marks, doc_ids: DataFrame, now: int):
        name = f"marks-{now}-{uuid4().hex}"
        doc_ids.write.parquet(self.path(name))
        marks = [*marks, (name, now)]
        counted = []
        for s in segments:
            n = self.live(s, marks).count()
            counted.append(Segment(s.name, s.n_passages, s.n_passages - n, s.since))
        return counted, marks

    def written(self, measured: DataFrame, now: int) -> Segment:
        name = f"{PLACED}{now}-{uuid4().hex}"

        def keep(df: DataFrame, part: str, *by: str) -> DataFrame:
            path = self.path(f"{name}/{part}")
            df.write.partitionBy(*by).options(**SMALL).parquet(path)
            return self.spark.read.schema(df.schema).parquet(path)

        made = index_measured(measured, keep)
        return Segment(name, made.corpus.first()["n_passages"], 0, now)

    def settle(self, segments: list[Segment], marks: list[tuple[str, int]], now: int) -> None:
        """Merge what has come to like size, and write the version."""
        while True:
            tiers: dict[int, list[Segment]] = {}
            for s in segments:
                tiers.setdefault(int(math.log(max(s.n_passages - s.n_removed, 1), FAN)), []).append(s)
            group = next((g for g in tiers.values() if len(g) >= FAN), None)
            worn = [s for s in segments if s.n_removed > MOST_REMOVED * s.n_passages]
            group = group or worn[:1]
            if not group:
                break
            kept = [s for s in segments if s not in group]
            merged = reduce(DataFrame.unionByName, [self.live(s, marks) for s in group])
            new = self.written(in_places(merged), now)
            segments = [*kept, new] if new.n_passages else kept
        oldest = min((s.since for s in segments), default=now)
        marks = [m for m in marks if m[1] > oldest]
        rows = [("segment", s.name, s.n_passages, s.n_removed, s.since) for s in segments]
        rows += [("marks", name, 0, 0, since) for name, since in marks]
        self.spark.createDataFrame(rows, VERSION).coalesce(1).write.parquet(self.path(f"version-{now}"))

    def table(self, segment: Segment, part: str) -> DataFrame:
        return self.spark.read.parquet(self.path(f"{segment.name}/{part}"))

    def removed(self, segment: Segment, marks: list[tuple[str, int]]) -> DataFrame | None:
        """Ids of documents whose passages in the segment do not count any more."""
        names = [self.path(name) for name, since in marks if since > segment.since]
        return self.spark.read.parquet(*names).distinct() if names else None

    def live(self, segment: Segment, marks: list[tuple[str, int]]) -> DataFrame:
        passages, gone = self.table(segment, "passages"), self.removed(segment, marks)
        return passages if gone is None else passages.join(gone, "doc_id", "left_anti")

    def open(self, version: int | None = None) -> RulesIndex:
        """A version as an index to search. Its vocabulary and numbers are added up once."""
        segments, marks = self.listed(version)
        if not segments:
            empty = self.spark.createDataFrame([], "doc_id string, chunk_no int, chunk_id string, text string")
            return index_measured(measure_passages(empty))
        passages, blocks, terms, sums = [], [], [], []
        first_part = 0
        for s in segments:
            corpus = self.table(s, "corpus").first()
            live, lists = self.live(s, marks), self.table(s, "blocks")
            terms.append(self.table(s, "vocabulary").select("term", F.col("df").alias("n")))
            if s.n_removed:
                gone = stage(self.table(s, "passages").join(self.removed(s, marks), "doc_id", "left_semi"), "gone")
                terms.append(gone.select(F.explode(F.map_keys("counts")).alias("term"), F.lit(-1).cast("long").alias("n")))
                n_parts = F.lit(corpus["n_parts"])
                part = part_of(F.col("chunk_id"), n_parts)
                if not s.name.startswith(PLACED):
                    part = F.pmod(F.xxhash64("chunk_id"), n_parts).cast("int")
                out = stage(gone.groupBy(part.alias("part")).agg(F.collect_set("chunk_id").alias("out")), "out")
                left = F.filter("items", lambda i: ~F.array_contains("out", i["chunk_id"]))
                items = F.when(F.col("out").isNull(), F.col("items")).otherwise(left)
                lists = lists.join(F.broadcast(out) if s.n_removed <= 1_000_000 else out, "part", "left")
                lists = lists.withColumn("items", items).where(F.size("items") > 0)
            passages.append(live)
            sums.append(live.select("n_terms", F.size("counts").alias("n")))
            mean = F.lit(corpus["mean_terms"] or 1.0)
            blocks.append(lists.select("term", (F.col("part") + first_part).alias("part"), "most", "items", "bucket", mean.alias("mean")))
            first_part += corpus["n_parts"]

        def all_of(frames: list[DataFrame]) -> DataFrame:
            return reduce(DataFrame.unionByName, frames)

        vocabulary = all_of(terms).groupBy("term").agg(F.sum("n").alias("df")).where("df > 0")
        corpus = stage(
            all_of(sums).agg(
                F.count("*").alias("n_passages"),
                F.avg("n_terms").alias("mean_terms"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("n_postings"),
                F.lit(first_part).alias("n_parts"),
            ),
            "corpus",
        )
        # A longer mean raises what a term gives, by no more than the means differ.
        longer = F.greatest(F.lit(corpus.first()["mean_terms"] or 1.0) / F.col("mean"), F.lit(1.0)) * (1 + 1e-12)
        raised = all_of(blocks).withColumn("most", F.col("most") * longer).drop("mean")
        return RulesIndex(all_of(passages), raised, stage(vocabulary, "vocabulary"), corpus)
