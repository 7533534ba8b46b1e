"""Near-duplicates by SimHash, linked through a Gray-order hierarchical index.

A fingerprint has 64 bits; a bit is set if it is set in more than half of the hashes of a
text's shingles. Documents link if their fingerprints differ in 3 bits or fewer, and links
make components.

The index holds each distinct fingerprint once, so copies cost nothing. Two fingerprints
that link agree on one of four 16-bit blocks, and on one of four 12-bit blocks of what is
left: each is written under 16 rearrangements that bring such a pair of blocks to the
front, and Spark deals and sorts them by their Gray rank. Fingerprints with the same front
blocks then lie in one run, neighbours differing in few bits. Each run is a tree: nodes of
16 hold the bits that all their members share, nodes above hold those shared by nodes. A
search goes down pairs of nodes, and drops a pair, with all below it, as soon as the
differences among shared bits exceed 3. Nodes that already hang together are not compared
again. Only as many links as join a run's components leave the task.

Components of the links over all runs come from rounds of star contraction, each a join of
links with the smallest neighbour of a node, written to the shared folder between rounds.

Empty and null texts have fingerprint zero and are linked like others. Texts of fewer
words than a shingle are one shingle. Rows with equal ids or equal texts each get a row.
A null id is never a component's id unless the component has no other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ledgerloom.llm.groups import text_key
from ledgerloom.llm.texts import give_back, ranges_within, slices, utf8, word_bounds
from ledgerloom.staging import stage

SHINGLE, SEED, FURTHEST = 3, 42, 3
SLICE_BYTES = 2 << 20
FRONT = 28  # bits of the two blocks in front
NODE = 16  # members of a node
PAIRS = 1 << 20  # pairs compared at once
LINES = 32  # runs up to this long are compared member by member

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Byte i of entry b is bit i of b, so that adding entries counts bits.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8")[:, 0]
U64 = np.uint64


def shingle_hashes(texts: pa.Array, words: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle, repeats included, and the bounds of each text's shingles."""
    data, offsets = utf8(texts)
    starts, ends, first = word_bounds(data, offsets)
    if len(starts) == 0:
        return np.zeros(0, U64), np.zeros(len(first), np.int64)
    where, at = ranges_within(starts, ends - starts + 1)
    joined = LOWER[data[np.minimum(where, len(data) - 1)]]
    ends = at + (ends - starts)
    joined[ends] = 32
    n_words = np.diff(first)
    n_shingles = np.where(n_words > 0, np.maximum(n_words - words + 1, 1), 0)
    left, _ = ranges_within(first[:-1], n_shingles)
    right = np.minimum(left + words - 1, np.repeat(first[1:] - 1, n_shingles))
    line, digest = joined.tobytes(), xxhash.xxh64_intdigest
    spans = zip(at[left].tolist(), ends[right].tolist(), strict=True)
    hashes = np.array([digest(line[a:b], seed) for a, b in spans], U64)
    return hashes, np.append(0, np.cumsum(n_shingles))


def majority(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each text, the bits set in more than half of its hashes."""
    n = np.diff(bounds)
    out = np.zeros(len(n), U64)
    some = np.flatnonzero(n)
    if len(some) == 0:
        return out
    counted = SPREAD[np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)]
    # A byte counts to 255: longer texts are added up in pieces.
    pieces = -(-n[some] // 255)
    place, first = ranges_within(np.zeros(len(some), np.int64), pieces)
    begins = np.repeat(bounds[some], pieces) + place * 255
    sums = np.add.reduceat(counted, begins, axis=0).view(np.uint8).reshape(-1, 64)
    totals = np.add.reduceat(sums, first, axis=0, dtype=np.int64)
    bits = totals * 2 > n[some, None]
    out[some] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprint(text: Column) -> Column:
    """SimHash of a whole text, as the bits of a long."""

    @F.arrow_udf("long")
    def made(texts: pa.Array) -> pa.Array:
        parts = [
            majority(*shingle_hashes(texts.slice(a, b - a), SHINGLE, SEED))
            for a, b in slices(texts, SLICE_BYTES)
        ]
        give_back()
        return pa.array(np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64))

    return made(text)


def arrangements() -> list[list[int]]:
    """Orders of the 64 bits, front first, with one block of 16 and one of 12 in front."""
    bits = list(range(63, -1, -1))
    orders = []
    for i in range(0, 64, 16):
        rest = bits[:i] + bits[i + 16 :]
        for j in range(0, 48, 12):
            orders.append(bits[i : i + 16] + rest[j : j + 12] + rest[:j] + rest[j + 12 :])
    return orders


ORDERS = arrangements()


def rearranged(values: np.ndarray, order: list[int]) -> np.ndarray:
    """Bit ``order[0]`` becomes the highest, and so on; runs of bits move together."""
    out = np.zeros(len(values), U64)
    at = 0
    while at < 64:
        to = at + 1
        while to < 64 and order[to] == order[to - 1] - 1:
            to += 1
        size = to - at
        piece = (values >> U64(order[to - 1])) & U64((1 << size) - 1)
        out |= piece << U64(64 - to)
        at = to
    return out


def restored(values: np.ndarray, order: list[int]) -> np.ndarray:
    back = [0] * 64
    for place, bit in enumerate(order):
        back[63 - bit] = 63 - place
    return rearranged(values, back)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the sequence in which neighbours differ in one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> U64(shift)
    return rank


def gray_code(ranks: np.ndarray) -> np.ndarray:
    return ranks ^ (ranks >> U64(1))


@F.arrow_udf(T.ArrayType(T.LongType()))
def ranks(prints: pa.Array) -> pa.Array:
    codes = prints.to_numpy(zero_copy_only=False).view(U64)
    table = np.stack([gray_rank(rearranged(codes, order)) for order in ORDERS], axis=1)
    bounds = np.arange(len(codes) + 1, dtype=np.int32) * len(ORDERS)
    return pa.ListArray.from_arrays(bounds, table.ravel().view(np.int64))


class Forest:
    """Which members of a run hang together."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while True:
                further = self.root[self.root]
                if (further == self.root).all():
                    break
                self.root = further


def tree(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the codes upwards: the bits all members share, and which bits those are."""
    shared, which = codes, np.full(len(codes), ~U64(0))
    levels = [(shared, which)]
    while len(shared) > NODE:
        begins = np.arange(0, len(shared), NODE)
        ones = np.bitwise_and.reduceat(shared, begins)
        zeros = np.bitwise_and.reduceat(~shared & which, begins)
        shared, which = ones, ones | zeros
        levels.append((shared & which, which))
    return levels


def search(codes: np.ndarray, forest: Forest, base: int) -> None:
    """Joins all codes of one run that differ in FURTHEST bits or fewer."""
    levels = tree(codes)
    top = len(levels) - 1
    n = len(levels[top][0])
    a, b = np.triu_indices(n)
    stack = [(top, a, b)]
    while stack:
        level, a, b = stack.pop()
        shared, which = levels[level]
        differ = np.bitwise_count((shared[a] ^ shared[b]) & which[a] & which[b])
        near = differ <= FURTHEST
        a, b = a[near], b[near]
        if level == 0:
            forest.join(a + base, b + base)
            continue
        # Members of a node that hang together with those of another need no search.
        roots = forest.root[base : base + len(codes)]
        size = NODE**level
        begins = np.arange(0, len(codes), size)
        low, high = np.minimum.reduceat(roots, begins), np.maximum.reduceat(roots, begins)
        one = (low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b])
        a, b = a[~one], b[~one]
        below = len(levels[level - 1][0])
        step = max(1, PAIRS // (NODE * NODE))
        for i in range(0, len(a), step):
            x, y = np.divmod(np.arange(NODE * NODE), NODE)
            left = (a[i : i + step, None] * NODE + x).ravel()
            right = (b[i : i + step, None] * NODE + y).ravel()
            keep = (left <= right) & (right < below) & (left < below)
            stack.append((level - 1, left[keep], right[keep]))


def run_links(arranged: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the components of every run of one sorted batch of whole runs."""
    codes = gray_code(rank)
    front = codes >> U64(64 - FRONT)
    opens = np.ones(len(codes), bool)
    opens[1:] = (front[1:] != front[:-1]) | (arranged[1:] != arranged[:-1])
    begins = np.flatnonzero(opens)
    lengths = np.diff(np.append(begins, len(codes)))
    forest = Forest(len(codes))
    short = np.repeat(lengths <= LINES, lengths)
    run = np.cumsum(opens) - 1
    for step in range(1, LINES):
        i = np.flatnonzero(short[:-step] & (run[step:] == run[:-step])) if step < len(codes) else []
        if len(i) == 0:
            break
        near = np.bitwise_count(codes[i] ^ codes[i + step]) <= FURTHEST
        forest.join(i[near], i[near] + step)
    for at, n in zip(begins[lengths > LINES], lengths[lengths > LINES], strict=True):
        search(codes[at : at + n], forest, at)
    leaves = np.flatnonzero(forest.root != np.arange(len(codes)))
    prints = np.zeros(len(codes), U64)
    for p in np.unique(arranged):
        own = arranged == p
        prints[own] = restored(codes[own], ORDERS[p])
    return prints[leaves].view(np.int64), prints[forest.root[leaves]].view(np.int64)


def link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts sorted batches at the ends of runs; a run may go over many batches."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def made(arranged: np.ndarray, rank: np.ndarray) -> pa.RecordBatch:
        a, b = run_links(arranged, rank)
        return pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        if batch.num_rows == 0:
            continue
        arranged = batch.column(0).to_numpy(zero_copy_only=False)
        rank = batch.column(1).to_numpy(zero_copy_only=False).view(U64)
        front = rank >> U64(64 - FRONT)
        last = (front == front[-1]) & (arranged == arranged[-1])
        cut = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
        if held and cut == 0:
            p, r = held[-1]
            if p[-1] == arranged[0] and r[-1] >> U64(64 - FRONT) == front[0]:
                held.append((arranged, rank))
                continue
        held.append((arranged[:cut], rank[:cut]))
        whole = [np.concatenate(x) for x in zip(*held, strict=True)]
        if len(whole[0]):
            yield made(*whole)
        held = [(arranged[cut:], rank[cut:])]
    if held and len(held[0][0]):
        yield made(*[np.concatenate(x) for x in zip(*held, strict=True)])


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough to join every component."""
    rows = prints.select(F.posexplode(ranks("print")).alias("arranged", "rank"))
    front = F.shiftrightunsigned("rank", 64 - FRONT)
    dealt = rows.repartition("arranged", front).sortWithinPartitions(
        "arranged", front, "rank"
    )
    return dealt.mapInArrow(link_batches, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with a link; the root is the smallest node reachable.

    Rounds of star contraction: every node's larger, then its smaller neighbours are
    linked to its smallest neighbour, until nothing changes.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stage(pairs.where("a > b").distinct(), "links")
    sign = None
    while True:
        both = now.union(now.select(F.col("b"), F.col("a")))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        low = low.select("a", F.least("a", "low").alias("low"))
        larger = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        star = stage(larger.distinct(), "links")
        low = star.groupBy("a").agg(F.min("b").alias("low"))
        joined = star.join(low, "a")
        smaller = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).where("a > b")
        now = stage(smaller.union(low).distinct(), "links")
        row = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        ).first()
        if tuple(row) == sign:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b"), F.col("b")).distinct()
            )
        sign = tuple(row)


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, print, group (a fingerprint that names the component), component_id."""
    marked = docs.select(
        "doc_id", text_key(F.col("text")).alias("text_key"), fingerprint(F.col("text")).alias("print")
    )
    marked = stage(marked, "prints")
    distinct = stage(marked.groupBy("print").agg(F.min("doc_id").alias("low")), "distinct")
    roots = components(stage(links(distinct), "links"))
    named = distinct.join(
        roots.withColumnRenamed("node", "print"), "print", "left"
    ).withColumn("group", F.coalesce("root", "print"))
    named = stage(named.select("print", "low", "group"), "named")
    lowest = named.groupBy("group").agg(F.min("low").alias("component_id"))
    of_print = named.join(lowest, "group").select("print", "group", "component_id")
    return marked.join(of_print, "print").select(
        "doc_id", "text_key", "print", "group", "component_id"
    )


def one_of_each(
    docs: DataFrame, groups_of: Callable[[DataFrame], DataFrame] = grouped
) -> DataFrame:
    """The document with the smallest id of each component, with all its columns.

    Of rows with that id, the one whose text has the smallest hash; of equal rows, one.
    ``groups_of`` gives doc_id, text_key, group and component_id of every row.
    """
    found = groups_of(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = found.groupBy("group").agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
    chosen = first.select(F.col("first.doc_id").alias("chosen_id"), F.col("first.text_key").alias("chosen_key"))
    keyed = docs.select(F.struct(*docs.columns).alias("row"), text_key(F.col("text")).alias("text_key"), "doc_id")
    same = F.col("doc_id").eqNullSafe(F.col("chosen_id")) & (F.col("text_key") == F.col("chosen_key"))
    kept = keyed.join(chosen, same, "left_semi")
    place = F.row_number().over(W.partitionBy("doc_id", "text_key").orderBy("doc_id"))
    return kept.withColumn("place", place).where("place = 1").select("row.*")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint as 16 hex digits, and component_id."""
    return grouped(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
