"""Counts tokens of byte-level BPE with compiled finite-state transducers.

Two deterministic machines are compiled. The first cuts a stream of texts into
pre-tokens; its chunk maps compose in a parallel prefix scan (see ``pretokens``). The
second reads the bytes of a pre-token. After each prefix its state is the last token of
that prefix's encoding, for the prefixes a further token can still begin at; an edge
reads one whole token, adds one to the count, and exists only between tokens that stand
side by side in an encoding. By that rule exactly one edge enters each prefix, so the
count at the end is the number of tokens that merging by rank would give, and no merging
is done. Two tokens stand side by side if undoing their merges, latest first, never
bares a pair that would have been merged earlier.

All distinct pre-tokens of a slice of texts run side by side, prefix length by prefix
length. Strings of special tokens inside a text count as one token each.

Empty and null texts have no tokens. The functions work on single values, so repeated
rows and other columns don't matter.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.pretokens import split
from ledgerloom.llm.texts import give_back, ranges_within, slices

# Bytes of text that are worked on at once.
SLICE_BYTES = 4 << 20
# Counts a worker remembers, and the longest pre-token it does it for.
REMEMBERED, LONGEST_REMEMBERED = 400_000, 64
NEVER = np.int64(1) << 40


def byte_characters() -> dict[str, int]:
    """The byte each character of a vocabulary file stands for.

    Fixed rule of the format: visible characters of Latin-1 stand for themselves, the
    other bytes, in order, for the characters from 256 on.
    """
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Lookup:
    """A fixed map from non-negative numbers to numbers, open addressing, for whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int64)
        left = np.arange(len(keys))
        at = self.home(keys)
        while len(left):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[left[free]]  # of several, the last is in
            self.values[at[free]] = values[left[free]]
            out = self.keys[at] != keys[left]
            left, at = left[out], (at[out] + 1) & self.mask

    def home(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 where there is none."""
        at = self.home(keys)
        out = self.values[at]
        seen = self.keys[at]
        open_ = np.flatnonzero((seen != keys) & (seen >= 0))
        out[(seen != keys)] = -1
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            seen = self.keys[at[open_]]
            hit = seen == keys[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (seen >= 0)]
        return out


class Counter:
    """The token transducer of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        to_byte = byte_characters()
        vocabulary: dict[str, int] = made["model"]["vocab"]
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in made["model"]["merges"]]
        self.specials = tuple(t["content"].encode() for t in made["added_tokens"])
        strings = sorted(vocabulary, key=vocabulary.get)
        number = {s: i for i, s in enumerate(strings)}
        n = self.n = len(strings)
        # When a token is made: its merge; bytes are never made. And of what it is made.
        self.made = np.full(n, -1, np.int64)
        self.left, self.right = np.arange(n), np.arange(n)
        pairs, at = [], []
        for i, (a, b) in enumerate(merges):
            t = number[a + b]
            if self.made[t] < 0:
                self.made[t], self.left[t], self.right[t] = i, number[a], number[b]
            pairs.append(number[a] * n + number[b])
            at.append(i)
        self.merge = Lookup(np.array(pairs), np.array(at))
        # The trie of all tokens: node and byte to node; node to token.
        nodes: dict[tuple[int, int], int] = {}
        token_at = {}
        for s, t in number.items():
            node = 0
            for c in s:
                node = nodes.setdefault((node, to_byte[c]), len(nodes) + 1)
            token_at[node] = t
        self.step = Lookup(
            np.array([a * 256 + b for a, b in nodes]), np.array(list(nodes.values()))
        )
        self.token = np.full(len(nodes) + 1, -1, np.int64)
        self.token[list(token_at)] = list(token_at.values())
        self.known: dict[bytes, int] = {}

    def side_by_side(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether tokens ``a`` and ``b`` can follow each other in an encoding.

        The later made of the two is undone, until both are bytes. The pair now bared
        must not have a merge that comes before the undone one; between merges of equal
        rank the left place goes first.
        """
        fits = np.ones(len(a), bool)
        left = np.arange(len(a))
        undone = np.full(len(a), NEVER)
        a, b = a.copy(), b.copy()
        while len(left):
            rank = self.merge(a * self.n + b)
            clash = (rank >= 0) & (rank * 2 + 1 < undone)
            fits[left[clash]] = False
            made_a, made_b = self.made[a], self.made[b]
            on = ~clash & ((made_a >= 0) | (made_b >= 0))
            left, a, b, undone = left[on], a[on], b[on], undone[on]
            made_a, made_b = made_a[on], made_b[on]
            # Of equal merges the left one, in a, was made first: it is undone last, and
            # the seam's own merge loses to it but not to the one in b.
            take_a = made_a > made_b
            undone = np.where(take_a, made_a * 2 + 1, made_b * 2 + 2)
            a = np.where(take_a, self.right[a], a)
            b = np.where(take_a, b, self.left[b])
        return fits

    def count(self, strings: list[bytes]) -> np.ndarray:
        """Number of tokens of each pre-token; none is empty."""
        data = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64)
        lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        base = np.cumsum(lengths) - lengths
        # All tokens that stand in a pre-token, found from all places side by side.
        places, _ = ranges_within(np.zeros(len(lengths), np.int64), lengths)
        stop = np.repeat(base + lengths, lengths)
        begin = np.arange(len(data))
        node = np.zeros(len(data), np.int64)
        edges, size = [], 0
        while len(begin):
            node = self.step(node * 256 + data[begin + size])
            size += 1
            on = node >= 0
            begin, node = begin[on], node[on]
            token = self.token[node]
            is_token = token >= 0
            edges.append((begin[is_token], np.full(is_token.sum(), size), token[is_token]))
            on = begin + size < stop[begin]
            begin, node = begin[on], node[on]
        begin, size, token = (np.concatenate(parts) for parts in zip(*edges, strict=True))
        # Edges in the order of the prefix they complete.
        reach = places[begin] + size
        order = np.argsort(reach, kind="stable")
        begin, size, token, reach = begin[order], size[order], token[order], reach[order]
        groups = np.flatnonzero(np.diff(reach, prepend=0))
        last = np.full(len(data), -1, np.int64)  # of the prefix that ends with this byte
        n_tokens = np.zeros(len(data), np.int64)
        for lo, hi in zip(groups, np.append(groups[1:], len(reach)), strict=True):
            b, s, t = begin[lo:hi], size[lo:hi], token[lo:hi]
            opening = places[b] == 0
            fits = opening.copy()
            inner = np.flatnonzero(~opening)
            fits[inner] = self.side_by_side(last[b[inner] - 1], t[inner])
            b, s, t, opening = b[fits], s[fits], t[fits], opening[fits]
            # A whole token is an edge from the start only if its own encoding is itself.
            before = np.where(opening, 0, n_tokens[b - 1])
            last[b + s - 1] = t
            n_tokens[b + s - 1] = before + 1
        return n_tokens[base + lengths - 1]

    def text_counts(self, texts: pa.Array) -> np.ndarray:
        found = split(texts, self.specials)
        if len(self.known) > REMEMBERED:
            self.known = {}
        for s in self.specials:
            self.known[s] = 1
        new = [s for s in found.strings if s not in self.known]
        if new:
            self.known.update(zip(new, self.count(new).tolist(), strict=True))
        counts = np.fromiter(map(self.known.__getitem__, found.strings), np.int64, len(found.strings))
        for s in new:
            if len(s) > LONGEST_REMEMBERED:
                del self.known[s]
        each = counts[found.codes]
        each[found.ends] = 0
        return np.diff(np.cumsum(each)[found.ends], prepend=0)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_count(text: Column, path: str) -> Column:
    """Number of tokens of a whole text, by the vocabulary file at ``path``."""

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        parts = [counter(path).text_counts(texts.slice(a, b - a)) for a, b in slices(texts, SLICE_BYTES)]
        give_back()
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))

    return count(text)


def count_tokens(docs: DataFrame, path: str, limit: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether a text has more than ``limit`` tokens."""
    sized = docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(F.col("text"), path).alias("n_tokens"),
    )
    return sized.withColumn("over_limit", F.col("n_tokens") > limit)
