"""An index that grows, against one built afresh."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import index as index_module
from ledgerloom.operators import segments as segments_module
from ledgerloom.operators.index import build_index, index_report
from ledgerloom.operators.passages import chunk
from ledgerloom.operators.search import search_rules
from ledgerloom.operators.segments import GrowingIndex


def files(folder):
    return {
        os.path.join(at, name): os.stat(os.path.join(at, name)).st_mtime_ns
        for at, _, names in os.walk(folder)
        for name in names
    }


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


class Desk:
    """A growing index and the texts that should be in it."""

    def __init__(self, spark, root):
        self.spark, self.texts = spark, {}
        self.index = GrowingIndex(spark, str(root))

    def frame(self, texts):
        return self.spark.createDataFrame(list(texts.items()), "doc_id int, text string")

    def add(self, texts):
        self.index.add(chunk(self.frame(texts), 12, 2))
        self.texts |= texts

    def remove(self, ids):
        self.index.remove(self.spark.createDataFrame([(i,) for i in ids], "doc_id int"))
        for i in ids:
            self.texts.pop(i, None)

    def check(self):
        opened, fresh = self.index.open(), build_index(chunk(self.frame(self.texts), 12, 2))
        assert rows_of(opened.vocabulary, "term", "df") == rows_of(fresh.vocabulary, "term", "df")
        listed = ("term", "chunk_id", "tf", "n_terms")
        assert rows_of(opened.postings, *listed) == rows_of(fresh.postings, *listed)
        numbers = ("n_passages", "mean_terms", "n_postings")
        assert opened.corpus.select(*numbers).first() == fresh.corpus.select(*numbers).first()
        assert index_report(opened).first() == index_report(fresh).first()
        asked = [(i, t) for i, t in enumerate(["the w1", "w2 w3 of", "w7", "the of", *list(self.texts.values())[:3]])]
        questions = self.spark.createDataFrame(asked, "question_id int, text string")
        found = [
            rows_of(search_rules(questions, i, 4, way), "question_id", "rank", "chunk_id", "score")
            for i, way in ((fresh, "scan"), (opened, "scan"), (opened, "postings"))
        ]
        assert found[0] == found[1] == found[2] and found[0]


@pytest.fixture
def few_parts(monkeypatch):
    monkeypatch.setattr(index_module, "BUCKETS", 2)
    monkeypatch.setattr(index_module, "PART_PASSAGES", 8)


def texts(first, n, seed):
    rng = random.Random(seed)
    words = ["the"] * 9 + ["of"] * 5 + [f"w{i}" for i in range(15)]
    return {i: " ".join(rng.choices(words, k=rng.randint(1, 40))) for i in range(first, first + n)}


def test_grows_like_one_built_afresh(spark, tmp_path, few_parts):
    desk = Desk(spark, tmp_path / "index")
    desk.add(texts(0, 40, 1))
    old = desk.index.listed()[0][0].name
    before = files(tmp_path / "index" / old)
    desk.add(texts(100, 6, 2))
    desk.remove([3, 4, 5, 101, 999])
    desk.add(texts(2, 5, 3))  # some there, some removed before, one never seen
    desk.check()
    # The large segment is still there, and as it was written.
    segments, marks = desk.index.listed()
    assert old in {s.name for s in segments} and marks
    assert files(tmp_path / "index" / old) == before
    # What was opened before stays as it was; a version that was not finished does not count.
    earlier = desk.index.open(desk.index.version() - 1)
    assert earlier.passages.where("doc_id = 3").isEmpty()
    unfinished = tmp_path / "index" / "version-99"
    unfinished.mkdir()
    (unfinished / "part-0.parquet").write_bytes(b"")
    assert desk.index.version() == 4 and not desk.index.open().passages.where("doc_id = 3").isEmpty()


def test_segments_of_like_size_are_merged(spark, tmp_path, few_parts):
    desk = Desk(spark, tmp_path / "index")
    made = []
    for i in range(8):
        desk.add(texts(100 * i, 2, i))
        made.append(len(desk.index.listed()[0]))
    # Two sizes at most, and fewer than FAN of each.
    assert max(made) <= 2 * (segments_module.FAN - 1) and made[-1] < 6
    desk.check()


def test_removing_most_rewrites_a_segment_and_removing_all_leaves_nothing(spark, tmp_path, few_parts):
    desk = Desk(spark, tmp_path / "index")
    desk.add(texts(0, 10, 1))
    desk.remove(range(8))
    segments, marks = desk.index.listed()
    assert [s.n_removed for s in segments] == [0] and not marks
    desk.check()
    desk.remove([8, 9])
    assert desk.index.open().passages.isEmpty()
    one = spark.createDataFrame([(1, "the")], "question_id int, text string")
    assert search_rules(one, desk.index.open(), 3).count() == 0


def test_opening_nothing(spark, tmp_path):
    index = GrowingIndex(spark, str(tmp_path / "none"))
    assert index.version() == 0 and index.open().passages.count() == 0
    assert index.open().corpus.select(F.col("n_passages")).first()[0] == 0
