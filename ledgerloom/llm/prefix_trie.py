"""The trie of conversation prefixes, from vertical bitmaps of shards.

Conversations are sequences of turns. Every distinct sequence of the first d turns of one
is a node of depth d; the root is the empty sequence.

Sorted by id, conversations are cut into shards of at most ``SHARD`` conversations and
``SHARD_TURNS`` turns; a longer conversation is a shard by itself. A shard's index is
vertical: for each (place, turn) the bitset of its conversations with that turn there, for
each length the bitset of those that end there. Depth first from the root, a node's bitset
is intersected with the postings of the next place, which gives its children; the
population count is the number of members, and the intersection with the ends is the
node's end list. A shard of one long conversation is a chain with one-bit bitsets, and is
passed on without being held.

Shards are then merged by node: a node's name is the hash of its sequence (128 bits over
SHA-256 of its turns), the same in all shards. Members are added up; a shard's end lists
are numbers in ascending order and shards are ranges of ids, so the lists of one node put
one behind the other are the whole list, of which nothing but its running digest is held.

Sums over subtrees take a second pass. Each node counts once, in the shard that holds its
smallest member: that conversation passes through all nodes above it, in the same shard.
Shards number their nodes depth first, so a subtree is a range, and a running sum gives
the sum of every range. The sums of equal nodes of all shards are added.

Rows without a conv_id take no part. Null role and text are empty. Turns are ordered by
turn, null first; turns with equal numbers by the digest of what they say; equal rows are
repeated turns. Texts are read whole and go no further than their digest. No
conversations, no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.staging import stage

SHARD, SHARD_TURNS = 1024, 1 << 16
BATCH = 1 << 14

# Fixed values of the rebuilding: ids that share a head, and the longest head.
FAMILY, HEAD = 100, 5

NODES = "shard long, pre long, last long, node binary, parent binary, depth long, conv_id long, n long, chars long, ends string"
ROOT = b""


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), key and chars of every turn; the texts stay where they are."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.unhex(F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text), 256))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", said.alias("key"), F.length(text).cast("long").alias("chars")
    )
    order = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "key")
    return turns.select("conv_id", F.row_number().over(order).cast("long").alias("place"), "key", "chars")


def head_length(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % (HEAD + 1)


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversations whose first turns are those of their family's first conversation.

    Takes and gives what :func:`numbered` gives; each conversation has a row more, with
    place 0, so that one without turns is there as well. At most 199 conversations share a
    family, and at most five turns of its first are sent to them.
    """
    turns = stage(turns, "turns")
    sizes = turns.groupBy("conv_id").agg(F.max("place").alias("n"))
    own = sizes.select(
        "conv_id", head_length(F.col("conv_id")).alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("first")
    )
    firsts = sizes.select(F.col("conv_id").alias("first"), F.col("n").alias("n_first"))
    taken = F.least("h", F.coalesce("n_first", F.lit(0).cast("long"))).alias("taken")
    plan = stage(own.join(firsts, "first", "left").select("conv_id", "first", "h", taken), "plan")
    heads = turns.where(F.col("place") <= HEAD).withColumnRenamed("conv_id", "first")
    head = plan.where("taken > 0").join(heads, "first").where("place <= taken")
    rest = turns.join(plan, "conv_id").where("place > h").withColumn("place", F.col("place") - F.col("h") + F.col("taken"))
    none = plan.select("conv_id", F.lit(0).cast("long").alias("place"), F.lit(None).cast("binary").alias("key"), F.lit(0).cast("long").alias("chars"))
    columns = ["conv_id", "place", "key", "chars"]
    return head.select(columns).union(rest.select(columns)).union(none)


def prefix(parent: bytes, key: bytes) -> bytes:
    return hashlib.blake2b(parent + key, digest_size=16).digest()


class Batch:
    """Rows of NODES on their way out."""

    def __init__(self):
        self.rows: list[tuple] = []

    def made(self) -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.binary()] * 2 + [pa.int64()] * 4 + [pa.string()]
        names = [part.split()[0] for part in NODES.split(", ")]
        columns = zip(*self.rows, strict=True) if self.rows else [[]] * len(kinds)
        made = pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
        self.rows = []
        return made


def members(bits: int) -> Iterator[int]:
    """The places of a bitset's bits, ascending."""
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def shard_nodes(ids: list[int], turns: list[list[tuple[bytes, int]]]) -> Iterator[tuple]:
    """Rows of NODES of one shard, numbered depth first."""
    postings: dict[tuple[int, bytes], int] = defaultdict(int)
    ends: dict[int, int] = defaultdict(int)
    for i, said in enumerate(turns):
        for place, (key, _) in enumerate(said):
            postings[place, key] |= 1 << i
        ends[len(said)] |= 1 << i
    rows: list[list] = []
    stack: list[tuple] = [((1 << len(ids)) - 1, 0, ROOT, None, 0)]
    while stack:
        entry = stack.pop()
        if len(entry) == 1:
            rows[entry[0]][2] = len(rows)
            continue
        bits, depth, node, parent, chars = entry
        ending = bits & ends.get(depth, 0)
        low = (bits & -bits).bit_length() - 1
        ended = ",".join(str(ids[i]) for i in members(ending)) if ending else None
        stack.append((len(rows),))
        rows.append([ids[0], len(rows), 0, node, parent, depth, ids[low], bits.bit_count(), chars, ended])
        rest, children = bits & ~ending, []
        while rest:
            key, size = turns[(rest & -rest).bit_length() - 1][depth]
            child = bits & postings[depth, key]
            children.append((child, depth + 1, prefix(node, key), node, size))
            rest &= ~child
        stack += reversed(children)
    yield from map(tuple, rows)


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of all shards of rows (conv_id, place, key, chars) sorted by conv_id and place."""
    out = Batch()
    ids: list[int] = []
    turns: list[list[tuple[bytes, int]]] = []
    held = 0
    # The chain of one long conversation, as far as it went: id, last node, its parent, depth, chars.
    chain: tuple | None = None

    def link(ended: bool) -> tuple:
        conv, node, parent, depth, chars = chain
        return (conv, depth, -1, node, parent, depth, conv, 1, chars, str(conv) if ended else None)

    def flush() -> None:
        nonlocal ids, turns, held
        if ids:
            out.rows += shard_nodes(ids, turns)
        ids, turns, held = [], [], 0

    for batch in batches:
        convs, places, keys, sizes = (c.to_pylist() for c in batch.columns)
        for conv, place, key, size in zip(convs, places, keys, sizes, strict=True):
            if chain and conv == chain[0]:
                out.rows.append(link(False))
                chain = (conv, prefix(chain[1], key), chain[1], chain[3] + 1, size)
            elif place == 0:
                if chain:
                    out.rows.append(link(True))
                    chain = None
                if len(ids) == SHARD or held >= SHARD_TURNS:
                    flush()
                ids.append(conv)
                turns.append([])
            else:
                turns[-1].append((key, size))
                held += 1
                if len(turns[-1]) > SHARD_TURNS:
                    # Too long to be held: what came before is a shard, this one a chain.
                    said = turns.pop()
                    ids.pop()
                    flush()
                    chain = (conv, ROOT, None, 0, 0)
                    for k, s in said:
                        out.rows.append(link(False))
                        chain = (conv, prefix(chain[1], k), chain[1], chain[3] + 1, s)
            if len(out.rows) >= BATCH:
                yield out.made()
    if chain:
        out.rows.append(link(True))
    flush()
    for a in range(0, len(out.rows), BATCH):
        part = Batch()
        part.rows = out.rows[a : a + BATCH]
        yield part.made()


def ends_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's end lists, joined by commas, from rows sorted by node and shard."""
    now, digest = None, None
    for batch in batches:
        nodes, hashed = [], []
        for node, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if node == now:
                digest.update(b",")
            else:
                if digest:
                    nodes.append(now)
                    hashed.append(digest.hexdigest())
                now, digest = node, hashlib.sha256()
            digest.update(ends.encode())
        yield pa.record_batch([pa.array(nodes, pa.binary()), pa.array(hashed, pa.string())], names=["node", "ends_sha256"])
    if digest:
        yield pa.record_batch([pa.array([now], pa.binary()), pa.array([digest.hexdigest()])], names=["node", "ends_sha256"])


def subtree_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, leaves and saved summed over each subtree, from rows (shard, pre, last, node,
    leaf, saved) sorted by shard and descending pre.

    Going backwards, the sum so far is that of all nodes numbered after this one; a
    subtree's sum is what was added since the node that follows it.
    """
    shard, so_far, after = None, (0, 0), {}
    for batch in batches:
        out = []
        rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
        for of, pre, last, node, leaf, saved in rows:
            if of != shard:
                shard, so_far, after = of, (0, 0), {}
            if last >= 0 and not after:
                after[last] = so_far
            since = after[last] if last >= 0 else (0, 0)
            so_far = (so_far[0] + leaf, so_far[1] + saved)
            if last >= 0:
                after[pre] = so_far
            out.append((node, so_far[0] - since[0], so_far[1] - since[1]))
        columns = list(zip(*out, strict=True)) or [[], [], []]
        kinds = (pa.binary(), pa.int64(), pa.int64())
        yield pa.record_batch(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["node", "n_leaves", "saved_tokens"]
        )


def trie(sequences: DataFrame) -> DataFrame:
    """All nodes of the trie of sequences (conv_id, place, key, chars, with a row of place 0
    for each): node, conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256.
    """
    sorted_ = sequences.repartitionByRange("conv_id").sortWithinPartitions("conv_id", "place")
    local = stage(sorted_.select("conv_id", "place", "key", "chars").mapInArrow(shards, NODES), "local")
    nodes = stage(
        local.groupBy("node").agg(
            F.min("conv_id").alias("conv_id"),
            F.min("depth").alias("depth"),
            F.min("parent").alias("parent"),
            F.sum("n").alias("n_convs"),
            F.min("chars").alias("chars"),
        ),
        "nodes",
    )
    children = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    none = F.lit(0).cast("long")
    facts = stage(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", none)), "facts")
    lists = local.where(F.col("ends").isNotNull()).select("node", "ends", "shard")
    lists = lists.repartition("node").sortWithinPartitions("node", "shard").select("node", "ends")
    ends = lists.mapInArrow(ends_digests, "node binary, ends_sha256 string")
    known = facts.select("node", F.col("conv_id").alias("smallest"), "n_convs", "n_children")
    own = F.col("conv_id") == F.col("smallest")
    leaf = F.when(own & (F.col("n_children") == 0), F.lit(1).cast("long")).otherwise(none)
    saved = F.when(own, (F.col("n_convs") - 1) * F.col("chars")).otherwise(none)
    counted = local.join(known, "node").select("shard", "pre", "last", "node", leaf.alias("leaf"), saved.alias("saved"))
    counted = counted.repartition("shard").sortWithinPartitions("shard", F.desc("pre"))
    parts = counted.mapInArrow(subtree_sums, "node binary, n_leaves long, saved_tokens long")
    sums = parts.groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    parents = facts.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    full = stage(facts.join(sums, "node").join(ends, "node", "left"), "full")
    nothing = F.lit(hashlib.sha256().hexdigest())
    return full.join(parents, "parent", "left").select(
        "node",
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )
