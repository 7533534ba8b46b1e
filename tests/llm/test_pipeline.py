"""The pipeline, stage by stage, against plain versions."""

from __future__ import annotations

import base64
import struct

import brute
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as pipeline
from ledgerloom.llm import mixing
from ledgerloom.staging import stage

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    made = [docs]
    for _, apply in pipeline.STAGES:
        made.append(stage(apply(spark, made[-1], SF_DIR), "step"))
    return made


def texts(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()))


def test_columns(steps):
    assert len(pipeline.STAGES) == 5
    assert all(df.columns == steps[0].columns for df in steps[1:-1])


def test_good_documents_stay(spark, steps):
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in steps[1].collect()}
    good = [d for d, q in quality.items() if q == 1]
    bad = [d for d, q in quality.items() if q == 0]
    assert sum(d in kept for d in good) >= 0.95 * len(good)
    assert sum(d in kept for d in bad) <= 0.5 * len(bad)


def test_one_of_each_group_stays(steps):
    rows = texts(steps[1])
    sets = [brute.shingle_set(t) for _, t in rows]
    low = brute.linked(rows, lambda i, j: brute.similar(sets[i], sets[j]) >= 0.8)
    first = [row for row, c in zip(rows, low, strict=True) if row[0] == c]
    kept = texts(steps[2])
    # No text leaves but for one that it is similar to; nearly all that may leave do.
    assert set(first) <= set(kept)
    assert len(kept) - len(first) <= 0.1 * (len(rows) - len(first))


def test_repeated_strings_go(steps):
    rows = texts(steps[2])
    expected = []
    for (doc, text), gone in zip(rows, brute.gone_bytes(rows), strict=True):
        at, kept = 0, []
        for c in text:
            n = len(c.encode())
            if not all(gone[at : at + n]):
                kept.append(c)
            at += n
        expected.append((doc, "".join(kept)))
    assert texts(steps[3]) == expected


def test_the_mix_is_what_was_planned(steps):
    plan = {r["doc_id"]: r["taken"] for r in mixing.mix_documents(steps[3]).collect() if r["taken"]}
    got = {}
    for doc, text in texts(steps[4]):
        got[doc] = got.get(doc, 0) + len(brute.words(text))
    assert got == plan


def test_ids_are_those_of_the_library(steps):
    path = public_tokenizers.path(pipeline.RANKS)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    expected = []
    for doc, text in texts(steps[4]):
        ids = library.encode_ordinary(text)
        expected.append((doc, len(ids), brute.sha(struct.pack(f"<{len(ids)}I", *ids)), brute.sha(text)))
    assert sorted(map(tuple, steps[5].collect())) == sorted(expected)


def test_run_does_all_stages(spark, steps):
    assert sorted(pipeline.run(spark, SF_DIR).collect()) == sorted(steps[5].collect())


def test_no_documents(spark, steps):
    docs = steps[0].limit(0)
    for _, apply in pipeline.STAGES:
        docs = apply(spark, docs, SF_DIR)
        assert docs.count() == 0


def test_a_text_of_two_sources_keeps_the_source_it_is_taken_from(spark):
    from pyspark.sql import functions as F

    rows = [(i, f"w{i} a b c d", "en", f"s{k}", 12) for i in range(400) for k in ((2, 3), (0, 1))[i % 2]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({n: F.lit("clash") for n in ("text_key", "copies", "parts", "place", "row", "size")})
    size = mixing.word_count(F.col("text"))
    plan = mixing.mixed(docs.select("doc_id", "source", size.alias("size")))
    extra = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["end"] - p["first"])
    words = F.sum(F.col("copies") * F.col("size") + extra).alias("words")
    expected = plan.groupBy("doc_id", "source").agg(words).where("words > 0")
    made = stage(mixing.mixed_documents(docs), "mixed")
    assert made.columns == docs.columns
    found = made.groupBy("doc_id", "source").agg(F.sum(size).alias("words"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    assert {r["text_key"] for r in made.collect()} == {"clash"}
