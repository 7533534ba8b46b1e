"""Documents whose five-word shingles are 0.8 similar or more, found by SimHash and verified.

Candidates come from the Gray-order index of ``simhash``, opened further: a text's
fingerprint is taken from its distinct five-word shingles and has two words of 64 bits, and
fingerprints may differ in FURTHEST of all bits. Unrelated texts do so with a chance of
10 ** -11. No fixed pair of blocks is then sure to be equal, so each distinct text is written
under many fixed arrangements of the bits of either word, and fingerprints with the same
front bits lie in one run. In texts of similarity 0.8 a bit is equal with a chance of 0.85.
The front grows with the logarithm of the number of texts, so runs stay short; with every
further bit there are more arrangements by 1 / 0.82, so what is found does not fall: by
calculation 0.94 of the pairs of similarity 0.8 and 0.99 of those of 0.9 (0.90 and 0.99 among
10 ** 10 texts).

A run gives a spanning forest of its candidates, nearest pairs first. Pairs of all runs are
then verified on the words themselves: first the nearest pair of every text, then the nearest
between every two groups still apart, then all that are left between groups. Only verified
pairs join groups, so every group hangs together by pairs of 0.8 or more. A run is held by
one task, 24 bytes a text.

Similarity is that of the sets of shingles: common ones by all. A-Z count as a-z. A text of
fewer words than five is one shingle; texts without words, null ones too, are alike. Rows of
equal text are one text; rows with equal ids each get a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.groups import text_key
from ledgerloom.llm.simhash import components, gray_code, gray_rank, majority, shingle_hashes
from ledgerloom.llm.texts import give_back, mix, slices
from ledgerloom.staging import stage

WORDS, SIMILAR, SEED = 5, 0.8, 42
FURTHEST = 26  # of 128 bits; texts of similarity 0.8 differ in 19 on average
LEAST_FRONT, LEAST_ARRANGED = 14, 64
RUN_BITS = 8  # a run of unrelated texts has about 2 ** RUN_BITS members at most
EQUAL = 0.82  # 0.85 of the bits are equal in texts of similarity 0.8; less leaves room for spread
SLICE_BYTES = 2 << 20
LINES = 32  # runs up to this long are compared line by line, longer ones in tiles
TILE = 512
PARTS = 1024  # pieces into which the pairs of one text are dealt

U64 = np.uint64


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every text, in order of their hash, and each text's bounds."""
    hashes, bounds = shingle_hashes(texts, WORDS, SEED)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.searchsorted(owner[new], np.arange(len(texts) + 1))


def fingerprint(text: Column) -> Column:
    """SimHash of the distinct shingles of a whole text, as the bits of two longs. The second
    is taken from the hashes' hashes."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def made(texts: pa.Array) -> pa.Array:
        parts = [np.zeros((0, 2), U64)]
        for a, b in slices(texts, SLICE_BYTES):
            hashes, bounds = shingle_sets(texts.slice(a, b - a))
            parts.append(np.stack([majority(hashes, bounds), majority(mix(hashes), bounds)], axis=1))
        give_back()
        whole = np.concatenate(parts)
        bounds = np.arange(len(whole) + 1, dtype=np.int32) * 2
        return pa.ListArray.from_arrays(bounds, whole.ravel().view(np.int64))

    return made(text)


def similarity(a: Column, b: Column) -> Column:
    """Common shingles of two texts by all their shingles; 1 if neither has a word."""

    @F.arrow_udf("double")
    def made(left: pa.Array, right: pa.Array) -> pa.Array:
        found = []
        for i, j in slices(left, SLICE_BYTES):
            one, at = shingle_sets(left.slice(i, j - i))
            for k, m in slices(right.slice(i, j - i), SLICE_BYTES):
                other, to = shingle_sets(right.slice(i + k, m - k))
                for n in range(k, m):
                    x, y = one[at[n] : at[n + 1]], other[to[n - k] : to[n - k + 1]]
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    whole = len(x) + len(y) - common
                    found.append(common / whole if whole else 1.0)
        give_back()
        return pa.array(found, pa.float64())

    return made(a, b)


def front_and_orders(n_texts: int) -> tuple[int, list[np.ndarray]]:
    """How many front bits texts of a run share, and the arrangements of the bits."""
    front = max(LEAST_FRONT, ceil(log2(max(n_texts, 1))) - RUN_BITS)
    n = ceil(LEAST_ARRANGED * EQUAL ** (LEAST_FRONT - front))
    rng = np.random.default_rng(SEED)
    return front, [rng.permutation(64) for _ in range(n)]


def bits_of(words: pa.Array) -> np.ndarray:
    """One row of 64 bits, highest first, for every word."""
    words = words.to_numpy(zero_copy_only=False).astype(">i8")
    return np.unpackbits(words.view(np.uint8).reshape(-1, 8), axis=1)


def ranks(first: Column, second: Column, orders: list[np.ndarray]) -> Column:
    """The Gray rank of a fingerprint under every arrangement, of its words by turns."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def made(first: pa.Array, second: pa.Array) -> pa.Array:
        words = bits_of(first), bits_of(second)
        table = np.empty((len(first), len(orders)), U64)
        for i, order in enumerate(orders):
            packed = np.ascontiguousarray(np.packbits(words[i % 2][:, order], axis=1))
            table[:, i] = gray_rank(packed.view(">u8")[:, 0].astype(U64))
        bounds = np.arange(len(first) + 1, dtype=np.int32) * len(orders)
        return pa.ListArray.from_arrays(bounds, table.ravel().view(np.int64))

    return made(first, second)


def spanning(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the pairs (a, b), earlier ones first, join what ``root`` has apart; joins it."""
    left, used = np.arange(len(a)), []
    while True:
        x, y = root[a[left]], root[b[left]]
        apart = x != y
        left, x, y = left[apart], x[apart], y[apart]
        if len(left) == 0:
            return np.concatenate(used) if used else left
        high, first = np.unique(np.maximum(x, y), return_index=True)
        root[high] = np.minimum(x, y)[first]
        used.append(left[first])
        while True:
            further = root[root]
            if (further == root).all():
                break
            root[:] = further


def nearest_first(codes: np.ndarray, root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs, as rows (a, b, bits that differ), that join what is near and apart."""
    differ = np.bitwise_count(codes[a] ^ codes[b]).sum(axis=1, dtype=np.int64)
    near = np.flatnonzero(differ <= FURTHEST)
    near = near[np.argsort(differ[near], kind="stable")]
    used = near[spanning(root, a[near], b[near])]
    return np.stack([a[used], b[used], differ[used]], axis=1)


def long_run(codes: np.ndarray) -> np.ndarray:
    """Candidates of one long run. Tiles of neighbours come first; two tiles that already hang
    together are not compared."""
    root, found = np.arange(len(codes)), []
    tiles = np.arange(0, len(codes), TILE)
    for apart in range(len(tiles)):
        for i in range(len(tiles) - apart):
            one = np.arange(tiles[i], min(tiles[i] + TILE, len(codes)))
            two = np.arange(tiles[i + apart], min(tiles[i + apart] + TILE, len(codes)))
            low = root[one[0]]
            if apart and (root[one] == low).all() and (root[two] == low).all():
                continue
            a, b = np.repeat(one, len(two)), np.tile(two, len(one))
            found.append(nearest_first(codes, root, a[a < b], b[a < b]))
    return np.concatenate(found)


def run_candidates(run: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Candidates of sorted whole runs; ``run`` numbers them."""
    begins = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    lengths = np.diff(np.append(begins, len(run)))
    short = np.repeat(lengths <= LINES, lengths)
    a, b = [], []
    for step in range(1, min(LINES, len(codes))):
        i = np.flatnonzero(short[:-step] & (run[step:] == run[:-step]))
        if len(i) == 0:
            break
        a.append(i)
        b.append(i + step)
    found = [np.zeros((0, 3), np.int64)]
    if a:
        found.append(nearest_first(codes, np.arange(len(codes)), np.concatenate(a), np.concatenate(b)))
    for at, n in zip(begins[lengths > LINES], lengths[lengths > LINES], strict=True):
        found.append(long_run(codes[at : at + n]) + [at, at, 0])
    return np.concatenate(found)


def candidates(prints: DataFrame) -> DataFrame:
    """(a, b, differ): pairs of texts, a < b, with the bits in which they differ."""
    front, orders = front_and_orders(prints.count())
    ranked = ranks(F.col("first"), F.col("second"), orders)
    rows = prints.select("*", F.posexplode(ranked).alias("arranged", "rank"))
    other = F.when(F.col("arranged") % 2 == 0, F.col("second")).otherwise(F.col("first"))
    rows = rows.select("text_key", "arranged", "rank", other.alias("other"))
    head = F.shiftrightunsigned("rank", 64 - front)
    dealt = rows.repartition("arranged", head).sortWithinPartitions("arranged", head, "rank", "text_key")

    def made(keys: np.ndarray, arranged: np.ndarray, rank: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
        head = rank >> U64(64 - front)
        new = (head[1:] != head[:-1]) | (arranged[1:] != arranged[:-1])
        codes = np.stack([gray_code(rank), other], axis=1)
        found = run_candidates(np.append(0, np.cumsum(new)), codes)
        one, two = keys[found[:, 0]], keys[found[:, 1]]
        columns = [np.minimum(one, two), np.maximum(one, two), found[:, 2].astype(np.int32)]
        return pa.record_batch([pa.array(c) for c in columns], names=["a", "b", "differ"])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys, arranged, *words = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            rank, other = (w.view(U64) for w in words)
            head = rank >> U64(64 - front)
            last = (head == head[-1]) & (arranged == arranged[-1])
            cut = 0 if last.all() else len(last) - int(np.argmin(last[::-1]))
            if held and cut == 0:
                _, p, r, _ = held[-1]
                if p[-1] == arranged[0] and r[-1] >> U64(64 - front) == head[0]:
                    held.append([keys, arranged, rank, other])
                    continue
            held.append([keys[:cut], arranged[:cut], rank[:cut], other[:cut]])
            whole = [np.concatenate(x) for x in zip(*held, strict=True)]
            if len(whole[0]):
                yield made(*whole)
            held = [[keys[cut:], arranged[cut:], rank[cut:], other[cut:]]]
        if held:
            yield made(*[np.concatenate(x) for x in zip(*held, strict=True)])

    pairs = dealt.mapInArrow(searched, "a long, b long, differ int")
    return pairs.groupBy("a", "b").agg(F.min("differ").alias("differ"))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that are similar. A text in many pairs is sent in parts."""
    rows = pairs.select("a", "b")
    for end, other in (("a", "b"), ("b", "a")):
        rows = rows.withColumn("part", F.pmod(F.xxhash64(other), F.lit(PARTS)))
        sent = pairs.select(end, F.pmod(F.xxhash64(other), F.lit(PARTS)).alias("part")).distinct()
        sent = sent.join(texts.select(F.col("text_key").alias(end), F.col("text").alias(f"{end}_text")), end)
        rows = rows.join(sent, [end, "part"]).drop("part")
    return rows.where(similarity(F.col("a_text"), F.col("b_text")) >= SIMILAR).select("a", "b")


def nearest(pairs: DataFrame, *by: str) -> DataFrame:
    """The pair with the least difference for every value of the columns ``by``."""
    best = pairs.groupBy(*by).agg(F.min(F.struct("differ", "a", "b")).alias("best"))
    return best.select("best.a", "best.b").distinct()


def joined(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, root) of every text that is similar to another, by verified pairs."""
    ends = pairs.select("*", F.explode(F.array("a", "b")).alias("end"))
    good = stage(verified(nearest(ends, "end"), texts), "verified")
    roots = components(good)
    for choose in (lambda rest: nearest(rest, "low", "high"), lambda rest: rest):
        of_a = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
        of_b = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
        rest = pairs.join(of_a, "a", "left").join(of_b, "b", "left")
        rest = rest.withColumns(
            {"root_a": F.coalesce("root_a", "a"), "root_b": F.coalesce("root_b", "b")}
        ).where("root_a <> root_b")
        rest = stage(
            rest.select(
                "a", "b", "differ",
                F.least("root_a", "root_b").alias("low"), F.greatest("root_a", "root_b").alias("high"),
            ),
            "rest",
        )
        if rest.isEmpty():
            break
        further = stage(verified(choose(rest), texts), "verified")
        if further.isEmpty():
            continue
        good = good.union(further)
        roots = components(good)
    return roots


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, group (a text_key that names the group), component_id (its least id;
    null only if no row of the group has an id)."""
    marked = docs.select(
        "doc_id", text_key(F.col("text")).alias("text_key"), fingerprint(F.col("text")).alias("print")
    )
    marked = stage(marked, "prints")
    distinct = marked.groupBy("text_key").agg(
        F.min(F.col("print")[0]).alias("first"), F.min(F.col("print")[1]).alias("second"), F.min("doc_id").alias("low")
    )
    distinct = stage(distinct, "distinct")
    pairs = stage(candidates(distinct.select("text_key", "first", "second")), "candidates")
    # Of copies, the one with the least id is read.
    asked = pairs.select(F.explode(F.array("a", "b")).alias("text_key")).distinct().join(distinct, "text_key")
    asked = asked.select(F.col("text_key").alias("key"), "low")
    whole = docs.select(
        "doc_id", text_key(F.col("text")).alias("text_key"), F.coalesce("text", F.lit("")).alias("text")
    )
    same = (F.col("text_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("low"))
    once = whole.join(asked, same, "left_semi").dropDuplicates(["text_key"])
    texts = stage(once.select("text_key", "text"), "texts")
    roots = joined(pairs, texts).withColumnRenamed("node", "text_key")
    named = distinct.join(roots, "text_key", "left").withColumn("group", F.coalesce("root", "text_key"))
    named = stage(named.select("text_key", "low", "group"), "named")
    lowest = named.groupBy("group").agg(F.min("low").alias("component_id"))
    of_text = named.join(lowest, "group").select("text_key", "group", "component_id")
    return marked.select("doc_id", "text_key").join(of_text, "text_key").select(
        "doc_id", "text_key", "group", "component_id"
    )
