"""Removes words of windows whose word sequence also starts in an earlier document.

Words are symbols, named by 64-bit hashes. A round of recompression names every run of
one symbol and then every pair of neighbours of which the left symbol falls in one half
of all names and the right one in the other. A name depends on what it stands for only,
so all groups give equal names to equal pieces without asking each other, and equal
sequences get equal symbols except near their ends. For each symbol the rounds keep the
words it stands for and, beyond them, the words its being there depends on: a symbol
whose words all lie in a window stands at that place in every equal window.

Each window picks among those the symbol of the highest round, the longest and then the
largest name. The words that the picked symbol depends on are named together: this key is
met again wherever the window is. A window without such a symbol, inside runs, is its own
key. Only windows whose key is met twice are looked at further (see ``groups``): they are
compared whole, by 96 bits of hash, and the smallest id of each goes back to the groups.

Null and empty texts have no words; texts shorter than a window lose none. Rows with equal
ids are not earlier than each other; a null id comes last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.groups import (
    KEYS, U64, by_bucket, deal, ids_of, in_sorted, joined, key_rows, meet, runs_of, settle, shared_keys, text_array,
)
from ledgerloom.llm.texts import hash_spans, keys, mix, ranges_within, utf8, word_bounds

WINDOW = 13
ROUNDS = 3
RUN, PAIR, SIDE, PICK, WHOLE, MORE = (keys(8, 77)[i] for i in range(6))


def word_names(data: np.ndarray, offsets: np.ndarray):
    """Names of all words, bounds of each text's words, and where words begin and end."""
    starts, ends, first = word_bounds(data, offsets)
    return hash_spans(data, starts, ends, 13), first, starts, ends


def merged(begins: np.ndarray, left, right, lo, hi, wide_lo, wide_hi):
    """Extents of symbols made of those from each begin to the next, with their neighbours."""
    if len(begins) == 0:
        return left, right, lo, hi
    ends = np.append(begins[1:], len(left)) - 1
    low = np.minimum(np.minimum.reduceat(lo, begins), wide_lo[begins])
    high = np.maximum(np.maximum.reduceat(hi, begins), wide_hi[ends])
    return left[begins], right[ends], low, high


def rounds(names: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Symbols of each round: name, first word, end, and the first word and end it depends on.

    A neighbour that is missing at the end of a text is a dependence on what lies outside.
    """
    n = len(names)
    name, left, right = names, np.arange(n), np.arange(n) + 1
    lo, hi = left.copy(), right.copy()
    head = np.zeros(n + 1, bool)
    head[first] = True
    for number in range(1, ROUNDS + 1):
        # Runs. Where one begins and ends depends on the symbols beside it, not on whole runs.
        wide_lo, wide_hi = beside(left, right, lo, hi, head)
        opens = np.ones(len(name), bool)
        opens[1:] = (name[1:] != name[:-1]) | head[left[1:]]
        begins = np.flatnonzero(opens)
        sizes = np.diff(np.append(begins, len(name)))
        one = name[begins]
        name = np.where(sizes > 1, mix(one ^ mix(sizes.astype(U64) * RUN)), one)
        left, right, lo, hi = merged(begins, left, right, lo, hi, wide_lo, wide_hi)
        # Pairs of a symbol of one half and one of the other.
        upper = (mix(name ^ (SIDE + U64(number))) & U64(1)).astype(bool)
        pair = np.zeros(len(name), bool)
        pair[:-1] = ~upper[:-1] & upper[1:] & ~head[left[1:]]
        wide_lo, wide_hi = beside(left, right, lo, hi, head)
        # One that is left single has looked at the neighbour on its open side.
        single_lo, single_hi = np.where(upper, wide_lo, lo), np.where(upper, hi, wide_hi)
        second = np.zeros(len(name), bool)
        second[1:] = pair[:-1]
        keep = np.flatnonzero(~second)
        with_next = pair[keep]
        next_ = np.minimum(keep + 1, len(name) - 1)
        new = np.where(with_next, mix(mix(name[keep] + PAIR) ^ name[next_]), name[keep])
        right = np.where(with_next, right[next_], right[keep])
        low = np.where(with_next, np.minimum(lo[keep], lo[next_]), single_lo[keep])
        high = np.where(with_next, np.maximum(hi[keep], hi[next_]), single_hi[keep])
        name, left, lo, hi = new, left[keep], low, high
        yield name, left, right, lo, hi


def beside(left, right, lo, hi, head) -> tuple[np.ndarray, np.ndarray]:
    """Extents widened to those of the neighbours; beyond a text's end, by one word."""
    wide_lo, wide_hi = lo.copy(), hi.copy()
    wide_lo[1:] = np.minimum(lo[1:], lo[:-1])
    wide_hi[:-1] = np.maximum(hi[:-1], hi[1:])
    at_head, at_end = head[left], head[right]
    wide_lo[at_head] = left[at_head] - 1
    wide_hi[at_end] = right[at_end] + 1
    return wide_lo, wide_hi


def sequence_names(names: np.ndarray, starts: np.ndarray, sizes: np.ndarray, seed) -> np.ndarray:
    """Names of the sequences of ``sizes`` words from ``starts``."""
    if len(starts) == 0:
        return np.zeros(0, U64)
    weights = mix(keys(64, 501) ^ U64(seed))
    out = sizes.astype(U64) * seed
    for i in range(int(sizes.max())):
        on = sizes > i
        out[on] += mix(names[starts[on] + i] ^ weights[i % 64])
        out[on] = mix(out[on])
    return out


def window_places(first: np.ndarray) -> np.ndarray:
    """First words of all windows."""
    room = np.maximum(np.diff(first) - WINDOW + 1, 0)
    return ranges_within(first[:-1], room)[0]


def window_keys(names: np.ndarray, first: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of all windows, and the number of its key for each window."""
    n = len(names)
    lo_of, hi_of = np.full(n, -1), np.zeros(n, np.int64)
    open_ = np.zeros(n, bool)
    open_[places] = True
    levels = list(rounds(names, first))
    for name, left, right, lo, hi in reversed(levels):
        fits = np.flatnonzero((right - left > 1) & (hi - lo <= WINDOW))
        # Longest first, then by name: written in rising order, the last one stays.
        rank = (right - left)[fits].astype(U64) << U64(56) | mix(name[fits] ^ PICK) >> U64(8)
        fits = fits[np.argsort(rank, kind="stable")]
        rank = np.sort(rank, kind="stable")
        picked = np.zeros(n, U64)
        who = np.full(n, -1)
        for back in range(WINDOW):
            at = lo[fits] - back
            ok = (at >= 0) & (at + WINDOW >= hi[fits])
            ok &= open_[np.maximum(at, 0)]
            at, own, value = at[ok], fits[ok], rank[ok]
            better = value >= picked[at]
            picked[at[better]], who[at[better]] = value[better], own[better]
        won = np.flatnonzero(who >= 0)
        lo_of[won], hi_of[won] = lo[who[won]], hi[who[won]]
        open_[won] = False
    lo_of, hi_of = lo_of[places], hi_of[places]
    none = lo_of < 0
    lo_of[none], hi_of[none] = places[none], places[none] + WINDOW
    # A key is named once for all windows that share its words.
    distinct, code = np.unique(lo_of * 64 + (hi_of - lo_of), return_inverse=True)
    return sequence_names(names, distinct // 64, distinct % 64, WHOLE), code


def send_keys(buckets: int):
    def run(g, _, documents: pa.Table) -> Iterator[pa.RecordBatch]:
        names, first, _, _ = word_names(*utf8(text_array(documents)))
        yield key_rows(g, window_keys(names, first, window_places(first))[0], buckets)

    return run


def window_names(names: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of name of each window."""
    sizes = np.full(len(places), WINDOW)
    return sequence_names(names, places, sizes, RUN), sequence_names(names, places, sizes, MORE) >> U64(32)


def text_numbers(first: np.ndarray, places: np.ndarray) -> np.ndarray:
    return np.searchsorted(first, places, "right") - 1


WINDOWS = "bucket int, g int, low binary, high binary, least binary, most binary"


def least_ids(low, high, ids) -> tuple[np.ndarray, ...]:
    """Distinct windows with the smallest and the largest id of each."""
    order = np.lexsort((ids, high, low))
    low, high, ids = low[order], high[order], ids[order]
    heads = np.flatnonzero(np.append(True, (low[1:] != low[:-1]) | (high[1:] != high[:-1]))) if len(low) else order
    lasts = np.append(heads[1:], len(low)).astype(int) - 1
    return low[heads], high[heads], ids[heads], ids[lasts]


def send_windows(buckets: int):
    def run(g, told: dict, documents: pa.Table) -> Iterator[pa.RecordBatch]:
        names, first, _, _ = word_names(*utf8(text_array(documents)))
        places = window_places(first)
        key, code = window_keys(names, first, places)
        places = places[in_sorted(key, np.sort(joined(told["shared"], U64)))[code]]
        low, high = window_names(names, places)
        low, high, least, most = least_ids(low, high, ids_of(documents)[text_numbers(first, places)])
        rows = [
            (i, g, low[at].tobytes(), high[at].astype(np.uint32).tobytes(), least[at].tobytes(), most[at].tobytes())
            for i, at in by_bucket(low, buckets)
        ]
        kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 4
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        yield pa.record_batch(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["bucket", "g", "low", "high", "least", "most"],
        )

    return run


def earlier_windows(sent: DataFrame) -> DataFrame:
    """(g, low, high, least): windows of a group that an id smaller than some of its own has."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in runs_of(batches, "bucket"):
            kinds = {"low": U64, "high": np.uint32, "least": np.int64, "most": np.int64}
            parts = {c: [np.frombuffer(x, k) for x in rows[c].to_pylist()] for c, k in kinds.items()}
            sizes = [len(x) for x in parts["low"]]
            low, high, least, most = (np.concatenate(parts[c]) for c in kinds)
            order = np.lexsort((least, high, low))
            heads = np.ones(len(order), bool)
            l, h = low[order], high[order]
            heads[1:] = (l[1:] != l[:-1]) | (h[1:] != h[:-1])
            smallest = np.empty(len(order), np.int64)
            smallest[order] = least[order][np.flatnonzero(heads)][np.cumsum(heads) - 1]
            cut = np.cumsum(sizes)[:-1]
            told = []
            for some in np.split(np.arange(len(order)), cut):
                on = some[most[some] > smallest[some]]
                told.append((low[on].tobytes(), high[on].tobytes(), smallest[on].tobytes()))
            columns = list(zip(*told, strict=True))
            yield pa.record_batch(
                [rows["g"].combine_chunks(), *[pa.array(c, pa.binary()) for c in columns]],
                names=["g", "low", "high", "least"],
            )

    dealt = sent.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(answer, "g int, low binary, high binary, least binary")


def finish(g, told: dict, documents: pa.Table) -> Iterator[pa.RecordBatch]:
    data, offsets = utf8(text_array(documents))
    names, first, starts, ends = word_names(data, offsets)
    places = window_places(first)
    low, high, least = joined(told["low"], U64), joined(told["high"], np.uint32), joined(told["least"], np.int64)
    order = np.argsort(low, kind="stable")
    low, high, least = low[order], high[order], least[order]
    removed = np.zeros(len(names) + 1, np.int64)
    if len(low) and len(places):
        mine, more = window_names(names, places)
        some = np.flatnonzero(in_sorted(mine, low))
        places, mine, more = places[some], mine[some], more[some].astype(np.uint32)
        ids = ids_of(documents)[text_numbers(first, places)]
        # Windows that share the first 64 bits follow each other: all are looked at.
        at = np.searchsorted(low, mine)
        covered = np.zeros(len(mine), bool)
        open_ = np.arange(len(mine))
        while len(open_):
            there = at[open_]
            covered[open_] |= (high[there] == more[open_]) & (least[there] < ids[open_])
            at[open_] += 1
            on = at[open_] < len(low)
            open_ = open_[on]
            open_ = open_[low[at[open_]] == mine[open_]]
        np.add.at(removed, places[covered], 1)
        np.add.at(removed, places[covered] + WINDOW, -1)
    gone = np.cumsum(removed[:-1]) > 0
    yield word_rows(documents, data, starts, ends, first, gone)


def word_rows(documents: pa.Table, data, starts, ends, first, gone) -> pa.RecordBatch:
    kept = ~gone
    sizes = (ends - starts + 1)[kept]
    where, at = ranges_within(starts[kept], sizes)
    line = data[np.minimum(where, max(len(data) - 1, 0))]
    line[at + sizes - 1] = 32
    bytes_at = np.append(at, len(line))
    upto = np.append(0, np.cumsum(kept))[first]
    n_removed = np.diff(np.append(0, np.cumsum(gone))[first])
    whole = line.tobytes()
    texts = [
        whole[bytes_at[a] : max(bytes_at[a], bytes_at[b] - 1)] for a, b in zip(upto[:-1], upto[1:], strict=True)
    ]
    return pa.record_batch(
        [
            documents["doc_id"].combine_chunks(), pa.array(np.diff(first)), pa.array(n_removed),
            pa.array([hashlib.sha256(t).hexdigest() for t in texts]), pa.array(texts, pa.string()),
        ],
        names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
    )


def kept_words(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept: the remaining words, joined by a space."""
    dealt, buckets = deal(docs)
    shared = settle(shared_keys(meet(dealt, None, send_keys(buckets), KEYS)), "keys")
    found = settle(earlier_windows(meet(dealt, shared, send_windows(buckets), WINDOWS)), "windows")
    return meet(
        dealt, found, finish, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    )


def digests(docs: DataFrame) -> DataFrame:
    """What :func:`kept_words` gives, without the words themselves."""
    return kept_words(docs).drop("kept")
