"""Scores texts for quality with supervised subword embeddings.

Each word gives a hashed vector of its own and one for each of its character n-grams of 3
to 5 characters, ends marked. A word also gives one of two fixed features when it repeats
the word before it or a pair of words that the text had before, and every text gives one
feature for its end, so that an empty text has a score too. The vectors of a text are
averaged and a softmax layer tells the label. Vectors and layer are trained by stochastic
gradient descent in numpy.

Training is on a bounded sample: the ``SAMPLE`` labelled ids with the smallest hashes
whose text has at most ``SAMPLE_BYTES``; only ids with crc32(doc_id as text) mod 3 other
than 1 are labels to learn from. The sample's features are counted in tasks, the driver
gets the counts only. Scoring needs one number per hash bucket (a vector's product with
the layer), a table of fixed size, and reads whole texts.

Null texts are empty. An id with several texts or labels is learned once, with the
smallest; every row is scored. Without any label all scores are 0.5. A null id is not held
out and never learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.texts import give_back, keys, mix, ranges_within, slices, utf8, word_bounds

SAMPLE, SAMPLE_BYTES = 3000, 1 << 14
BUCKETS = 1 << 18
# Examples that training looks at, some of them often.
STEPS = 24_000
DIM, RATE, SEED = 16, 0.5, 11
N_GRAMS = (3, 4, 5)
SLICE_BYTES = 2 << 20
# Distinct words that are scored at once.
WORDS = 20_000
# Buckets of the fixed features, and the first one for hashes.
END, SAME, PAIR, FIRST = 0, 1, 2, 3
LEFT, RIGHT = 60, 62  # code points of < and >
U64 = np.uint64


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes % U64(BUCKETS - FIRST)).astype(np.int64) + FIRST


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every distinct word, one word after the other, and where each begins."""
    text = "".join(f"<{w.decode('utf-8', 'replace')}>" for w in words)
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    sizes = np.fromiter((len(w.decode("utf-8", "replace")) + 2 for w in words), np.int64, len(words))
    ends = np.cumsum(sizes)
    stop = np.repeat(ends, sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    found, owners = [], []
    place = np.arange(len(points)) - (stop - sizes[owner])
    weights = keys(int(sizes.max()), 5)
    whole = np.add.reduceat((points.astype(U64) + U64(1)) * weights[place], ends - sizes)
    found.append(bucket(mix(whole)))
    owners.append(np.arange(len(words)))
    for n in N_GRAMS:
        begins = np.flatnonzero(np.arange(len(points)) + n <= stop)
        coded = np.zeros(len(begins), U64)
        for k, weight in enumerate(keys(n, 100 * n)):
            coded += (points[begins + k].astype(U64) + U64(1)) * weight
        found.append(bucket(mix(coded)))
        owners.append(owner[begins])
    owners, found = np.concatenate(owners), np.concatenate(found)
    order = np.argsort(owners, kind="stable")
    counts = np.bincount(owners, minlength=len(words))
    return found[order], np.append(0, np.cumsum(counts))


@dataclass
class Words:
    """The words of a slice of texts."""

    strings: list[bytes]
    codes: np.ndarray  # of each word, into strings
    text: np.ndarray  # of each word
    same: np.ndarray  # whether it repeats the word before
    pair: np.ndarray  # whether it closes a pair that the text had before
    n_texts: int


def read_words(texts: pa.Array) -> Words:
    data, offsets = utf8(texts)
    starts, ends, first = word_bounds(data, offsets)
    n = len(offsets) - 1
    text = np.repeat(np.arange(n), np.diff(first))
    if len(starts) == 0:
        none = np.zeros(0, bool)
        return Words([], starts, text, none, none, n)
    where, at = ranges_within(starts, ends - starts)
    bounds = np.append(at, len(where)).astype(np.int32)
    pieces = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data[where])]
    ).dictionary_encode()
    codes = pieces.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    inner = np.zeros(len(codes), bool)
    inner[1:] = text[1:] == text[:-1]
    before = np.roll(codes, 1)
    same = inner & (codes == before)
    coded = mix((text * len(pieces.dictionary) + before).astype(U64)) + codes.astype(U64)
    real = np.flatnonzero(inner)
    order = real[np.argsort(coded[real], kind="stable")]
    pair = np.zeros(len(codes), bool)
    pair[order[1:]] = coded[order[1:]] == coded[order[:-1]]
    return Words(pieces.dictionary.to_pylist(), codes, text, same, pair, n)


def counted(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of each text and the part of its features that each is."""
    w = read_words(texts)
    features, begins = word_features(w.strings) if w.strings else (np.zeros(0, np.int64), np.zeros(1, np.int64))
    bounds = np.searchsorted(w.text, np.arange(w.n_texts + 1))
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        codes = w.codes[a:b]
        where, _ = ranges_within(begins[codes], begins[codes + 1] - begins[codes])
        fixed = [END] + [SAME] * int(w.same[a:b].sum()) + [PAIR] * int(w.pair[a:b].sum())
        ids, n = np.unique(np.append(features[where], fixed).astype(np.int64), return_counts=True)
        out.append((ids, n / n.sum()))
    return out


@dataclass
class Model:
    vectors: np.ndarray  # bucket, dimension
    layer: np.ndarray  # label, dimension

    def table(self) -> np.ndarray:
        """What each bucket adds to label 1 against label 0."""
        return (self.vectors @ (self.layer[1] - self.layer[0])).astype(np.float32)


def train(examples: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """Stochastic gradient descent over the examples in seeded order, in doubles: single
    precision would let the last bits of a sum, which depend on where an array lies, grow."""
    rng = np.random.default_rng(SEED)
    vectors = (rng.random((BUCKETS, DIM)) - 0.5) / DIM
    layer = np.zeros((2, DIM))
    done = 0
    while done < STEPS:
        for i in rng.permutation(len(examples))[: STEPS - done]:
            ids, parts, label = examples[i]
            parts = parts.astype(float)
            rate = RATE * (1 - done / STEPS)
            done += 1
            mean = parts @ vectors[ids]
            raw = layer @ mean
            p = np.exp(raw - raw.max())
            p /= p.sum()
            p[label] -= 1
            pull = p @ layer
            layer -= rate * np.outer(p, mean)
            vectors[ids] -= np.outer(rate * parts, pull)
    return Model(vectors, layer)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def example_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.list_(pa.int32()), pa.list_(pa.float32()), pa.int32(), pa.int64()]
    for batch in batches:
        for a, b in slices(batch.column(0), SLICE_BYTES):
            made = counted(batch.column(0).slice(a, b - a))
            given = [batch.column(i).slice(a, b - a) for i in (1, 2)]
            values = [[m[0] for m in made], [m[1] for m in made], *given]
            yield pa.record_batch(
                [pa.array(v, k) for v, k in zip(values, kinds, strict=True)],
                names=["ids", "parts", "label", "doc_id"],
            )


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model of ``labels.quality``; None if no id can be learned from."""
    fair = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    once = fair.groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    small = docs.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= SAMPLE_BYTES)
    able = once.join(small.select("doc_id").distinct(), "doc_id", "left_semi")
    drawn = able.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(SAMPLE)
    # The sample has at most SAMPLE rows, so it is sent to the documents.
    texts = small.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    rows = texts.groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.first("label").alias("label"))
    found = rows.select("text", "label", "doc_id").mapInArrow(
        example_batches, "ids array<int>, parts array<float>, label int, doc_id long"
    ).toArrow()
    if found.num_rows == 0:
        return None
    examples = []
    for batch in found.to_batches():
        ids, parts = batch.column(0), batch.column(1)
        flat_ids = ids.flatten().to_numpy(zero_copy_only=False)
        flat_parts = parts.flatten().to_numpy(zero_copy_only=False)
        cuts = ids.offsets.to_numpy()
        cuts = cuts - cuts[0]
        labels_and_ids = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
        for i, (label, doc_id) in enumerate(labels_and_ids):
            part = slice(cuts[i], cuts[i + 1])
            examples.append((doc_id, flat_ids[part], flat_parts[part], label))
    # Rows come in no fixed order.
    examples.sort(key=lambda e: e[0])
    return train([e[1:] for e in examples])


def score(text: Column, model: Model | None) -> Column:
    """Probability of label 1 for a whole text."""
    table = np.zeros(BUCKETS, np.float32) if model is None else model.table()

    def of(texts: pa.Array) -> np.ndarray:
        w = read_words(texts)
        total = np.full(w.n_texts, float(table[END]))
        n = np.ones(w.n_texts)
        if w.strings:
            sums, sizes = np.zeros(len(w.strings)), np.zeros(len(w.strings), np.int64)
            for a in range(0, len(w.strings), WORDS):
                some = slice(a, a + WORDS)
                features, begins = word_features(w.strings[some])
                sums[some] = np.add.reduceat(table[features].astype(float), begins[:-1])
                sizes[some] = np.diff(begins)
            extra = w.same * float(table[SAME]) + w.pair * float(table[PAIR])
            total += np.bincount(w.text, sums[w.codes] + extra, w.n_texts)
            n += np.bincount(w.text, sizes[w.codes] + w.same.astype(int) + w.pair, w.n_texts)
        return 1 / (1 + np.exp(-total / n))

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        parts = [of(texts.slice(a, b - a)) for a, b in slices(texts, SLICE_BYTES)]
        give_back()
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return scored(text)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scored = docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"),
        score(F.col("text"), fit(docs, labels)).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier doesn't reject, with their columns."""
    model = fit(docs, labels)
    return docs.where(score(F.col("text"), model) >= 0.5)
