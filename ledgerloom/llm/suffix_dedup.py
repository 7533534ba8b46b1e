"""Removes bytes of strings of ``LENGTH`` bytes that also start earlier.

Every text is a row of bytes; a string that starts in a document with a smaller id, or
earlier in the same document, is earlier. What is removed is judged on the input.

Each string of ``LENGTH`` bytes has an anchor: of all ``GRAM``-byte strings in it the one
with the smallest hash, the leftmost of equal ones. Equal strings have equal anchors at
equal places, so only strings whose anchor is met twice are looked at further (see
``groups``). Neighbouring strings with one anchor are one piece of text; pieces with equal
anchors make a collection and are laid out in columns with their anchors in one column.

A collection is indexed column by column from the right, as its Burrows-Wheeler transform
is built for many documents at once: each round inserts one symbol in front of every
piece, a stable sort by that symbol turns the order of the suffixes into that of the
suffixes one longer, and the common prefixes of neighbours grow by one or, between
suffixes that had others between them, are the least of those plus one. The round's
transform, order and prefixes are arrays that are read and written in sequence. Where a
string starts, neighbours with a common prefix of ``LENGTH`` or more are equal strings.
Collections share nothing, so all that a task has run through the rounds side by side.

Pieces at the edges of a passage hold bytes of their own document, so an anchor that a
share of all documents has would gather as many pieces. Where an anchor has more than
``HOT``, its strings are dealt one by one instead, by 128 bits of hash: of each group those
with the smallest id, so a string arrives about once a group.

In a run of one character or of a short period the anchor moves with every period. Strings
of such a run that equal the one a period before them are known to go; only those of the
first period are made pieces.

Null and empty texts, and texts shorter than ``LENGTH``, lose nothing. Rows with equal
ids are documents of their own and not earlier than each other; a null id comes last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.groups import (
    KEYS, U64, by_bucket, deal, ids_of, in_sorted, joined, meet, runs_of, settle, text_array,
)
from ledgerloom.llm.texts import give_back, mix, ranges_within, utf8

LENGTH = 100
GRAM = 32
PLACES = LENGTH - GRAM + 1  # where an anchor may stand in a string
BASE, INVERSE = U64(0x9E3779B97F4A7C15), U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BLOCK = 1 << 19  # bytes hashed at once
INDEX_BITS = 24
# Pieces that run through the rounds together, and the least a batch of them waits for.
PIECES = 60_000
# Pieces of one anchor, equal ones of a group counted once, beyond which its strings are
# dealt singly, to so many buckets for each bucket of keys.
HOT = 2_000
STRING_BUCKETS = 8
DIGESTS = 1 << 16  # hashes made at once
SENT = 1 << 14  # pieces cut at once


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes at every place that has so many."""
    n = len(data)
    powers = np.full(n, BASE)
    powers[0] = 1
    powers = np.cumprod(powers)
    back = np.full(n, INVERSE)
    back[0] = 1
    back = np.cumprod(back)
    sums = np.zeros(n + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * powers, out=sums[1:])
    return mix((sums[GRAM:] - sums[:-GRAM]) * back[: n - GRAM + 1])


def least_of_each(values: np.ndarray) -> np.ndarray:
    """The least of every ``PLACES`` neighbours, from running minima of blocks."""
    n = len(values)
    padded = np.full(-(-n // PLACES) * PLACES, np.iinfo(np.uint64).max, U64)
    padded[:n] = values
    blocks = padded.reshape(-1, PLACES)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - PLACES + 1], ahead[PLACES - 1 : n])


def bounds_of(anchor: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of the neighbouring strings that are ``ok`` and have one anchor."""
    opens, closes = ok.copy(), ok.copy()
    opens[1:] &= (anchor[1:] != anchor[:-1]) | ~ok[:-1]
    closes[:-1] &= opens[1:] | ~ok[1:]
    return np.flatnonzero(opens), np.flatnonzero(closes)


def periodic(part: np.ndarray, key: np.ndarray, anchor: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Strings of a block, by place, that equal the one a period earlier in their text.

    Equal strings have equal anchors at equal places, so neighbouring pieces with one key
    tell the period: the distance of their anchors.
    """
    gone = np.zeros(max(len(part) - LENGTH + 1, 0), bool)
    if len(first) < 2:
        return gone
    beside = np.append(False, first[1:] == last[:-1] + 1)
    begin = first[np.maximum.accumulate(np.where(beside, 0, np.arange(len(first))))]
    again = np.flatnonzero(beside & np.append(False, key[1:] == key[:-1]))
    if len(again) == 0:
        return gone
    period = (anchor[again] - anchor[again - 1]).astype(np.int64)
    heads = np.ones(len(again), bool)
    heads[1:] = (np.diff(again) != 1) | (np.diff(period) != 0)
    a = np.flatnonzero(heads)
    period, low, high = period[a], first[again[a]], last[again[np.append(a[1:], len(again)) - 1]]
    low = np.maximum(low, begin[again[a]] + period)
    some = low <= high
    period, low, high = period[some], low[some], high[some]
    where, at = ranges_within(low, high - low + LENGTH)
    differ = part[where] != part[where - np.repeat(period, high - low + LENGTH)]
    before = np.append(0, np.cumsum(differ))
    place, _ = ranges_within(at, high - low + 1)
    string, _ = ranges_within(low, high - low + 1)
    gone[string] = before[place + LENGTH] == before[place]
    return gone


def pieces_of(data: np.ndarray, offsets: np.ndarray) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, np.ndarray]]:
    """Key, anchor, first and last string of every piece, and its text's number; then first
    and last string of every run of strings that equal one a period earlier."""
    found, runs = [], []
    ends = offsets[1:]
    low = U64((1 << INDEX_BITS) - 1)
    for a in range(0, max(len(data) - LENGTH + 1, 0), BLOCK):
        part = data[a : a + BLOCK + LENGTH - 1]
        hashes = gram_hashes(part)
        coded = (hashes & ~low) | np.arange(len(hashes), dtype=U64)
        anchor = (least_of_each(coded) & low).astype(np.int64)
        # No string starts so near the end of its text.
        ok = np.ones(len(anchor), bool)
        cuts = ends[np.searchsorted(ends, a, "right") : np.searchsorted(ends, a + len(anchor) + LENGTH)] - a
        over, _ = ranges_within(np.maximum(cuts - LENGTH + 1, 0), np.minimum(cuts, LENGTH - 1))
        ok[over[over < len(ok)]] = False
        first, last = bounds_of(anchor, ok)
        gone = periodic(part, hashes[anchor[first]], anchor[first], first, last)
        if gone.any():
            first, last = bounds_of(anchor, ok & ~gone)
            runs.append([x + a for x in bounds_of(np.zeros(len(gone)), gone)])
        found.append((hashes[anchor[first]], anchor[first] + a, first + a, last + a))
    none = np.zeros(0, np.int64)
    key, anchor, first, last = (np.concatenate(x) for x in zip((none.astype(U64), none, none, none), *found, strict=True))
    again = tuple(np.concatenate(x) for x in zip((none, none), *runs, strict=True))
    return (key, anchor, first, last, np.searchsorted(offsets, first, "right") - 1), again


def each_once(documents: pa.Table) -> pa.Table:
    """One of the rows with equal id and text: what goes from one goes from all of them."""
    ids, text_keys = ids_of(documents), documents["text_key"].to_numpy()
    order = np.lexsort((text_keys, ids))
    first = np.ones(len(order), bool)
    first[1:] = (np.diff(ids[order]) != 0) | (np.diff(text_keys[order]) != 0)
    return documents if first.all() else documents.take(pa.array(np.sort(order[first])))


def hashes_of(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """128 bits of hash of each span, as two numbers."""
    out = np.zeros((len(starts), 2), U64)
    view, digest = memoryview(data), xxhash.xxh3_128_digest
    for i in range(0, len(starts), DIGESTS):
        a = starts[i : i + DIGESTS]
        spans = zip(a.tolist(), (a + sizes[i : i + DIGESTS]).tolist(), strict=True)
        out[i : i + DIGESTS] = np.frombuffer(b"".join([digest(view[x:y]) for x, y in spans]), "<u8").reshape(-1, 2)
    return out


def numbered(hashes: np.ndarray) -> np.ndarray:
    """A number for each hash, the same for equal ones."""
    order = np.lexsort((hashes[:, 1], hashes[:, 0]))
    new = np.any(np.diff(hashes[order], axis=0, prepend=hashes[order[:1]]) != 0, axis=1)
    out = np.empty(len(hashes), np.int64)
    out[order] = np.cumsum(new)
    return out


COUNTED = KEYS + ", times binary"


def send_keys(buckets: int):
    """Distinct keys of a group, and how many distinct pieces those have that are met often."""

    def run(g, _, documents: pa.Table) -> Iterator[pa.RecordBatch]:
        data, offsets = utf8(text_array(each_once(documents)))
        key, _, first, last, _ = pieces_of(data, offsets)[0]
        distinct, of, n = np.unique(key, return_inverse=True, return_counts=True)
        again = np.flatnonzero(n[of] > 1)
        codes = numbered(hashes_of(data, first[again], (last - first + LENGTH)[again]))
        _, some = np.unique(codes, return_index=True)
        times = np.bincount(of[again][some], minlength=len(distinct)).astype(np.int32)
        rows = [
            (i, g, distinct[at][n[at] == 1].tobytes(), distinct[at][n[at] > 1].tobytes(), times[at][n[at] > 1].tobytes())
            for i, at in by_bucket(distinct, buckets)
        ]
        kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 3
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        names = [c.split()[0] for c in COUNTED.split(", ")]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def shared_and_hot(sent: DataFrame, most: int) -> DataFrame:
    """(g, shared, hot): the keys of each group that are met more than once in all groups,
    and those of them with more than ``most`` pieces."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in runs_of(batches, "bucket"):
            kinds = {"once": U64, "often": U64, "times": np.int32}
            once, often, times = ([np.frombuffer(x, k) for x in rows[c].to_pylist()] for c, k in kinds.items())
            every = np.sort(np.concatenate(once + often + often))
            shared = np.unique(every[:-1][every[1:] == every[:-1]])
            once = [x[in_sorted(x, shared)] for x in once]
            n = np.zeros(len(shared), np.int64)
            for a, b, t in zip(once, often, times, strict=True):
                n[np.searchsorted(shared, a)] += 1
                n[np.searchsorted(shared, b)] += t
            told, hot = [np.append(a, b) for a, b in zip(once, often, strict=True)], shared[n > most]
            columns = [[x.tobytes() for x in told], [x[in_sorted(x, hot)].tobytes() for x in told]]
            yield pa.record_batch(
                [pa.array(rows["g"].to_pylist(), pa.int32()), *[pa.array(c, pa.binary()) for c in columns]],
                names=["g", "shared", "hot"],
            )

    dealt = sent.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(answer, "g int, shared binary, hot binary")


# In place of the bytes before the anchor: the row holds spans, or strings by their hash.
PACKED, STRINGS = -1, -2
STRING = np.dtype([("hash", "<u8", 2), ("doc_id", "<i8"), ("text_key", "<i8"), ("start", "<i8")])
PIECE = "key long, g int, doc_id long, text_key long, start long, before int, strings int, piece binary"
NAMES = [c.split()[0] for c in PIECE.split(", ")]


def send_pieces(buckets: int):
    """The pieces whose anchor is met elsewhere too, or their strings where it is hot.

    Of equal pieces or strings in a group only those that no other precedes are sent; all
    strings of the others are known to go and travel packed, one row for the group.
    """

    def run(g, told: dict, documents: pa.Table) -> Iterator[pa.RecordBatch]:
        documents = each_once(documents)
        data, offsets = utf8(text_array(documents))
        (key, anchor, first, last, text), (run_first, run_last) = pieces_of(data, offsets)
        on = in_sorted(key, np.sort(joined(told["shared"], U64)))
        key, anchor, first, last, text = (x[on] for x in (key, anchor, first, last, text))
        ids, text_keys = ids_of(documents), documents["text_key"].to_numpy()
        codes = numbered(hashes_of(data, first, last - first + LENGTH))
        gone = preceded(codes, ids[text], text_keys[text], first)
        known = [
            (text[gone], first[gone], (last - first + 1)[gone]),
            (np.searchsorted(offsets, run_first, "right") - 1, run_first, run_last - run_first + 1),
        ]
        hot = ~gone & in_sorted(key, np.sort(joined(told["hot"], U64)))
        single, n = ranges_within(first[hot], (last - first + 1)[hot])[0], (last - first + 1)[hot]
        owner = np.repeat(text[hot], n)
        hashes = hashes_of(data, single, np.full(len(single), LENGTH))
        lost = preceded(numbered(hashes), ids[owner], text_keys[owner], single)
        known.append((owner[lost], single[lost], np.ones(int(lost.sum()), np.int64)))
        left = np.flatnonzero(~lost)
        strings = np.zeros(len(left), STRING)
        strings["hash"], strings["start"] = hashes[left], single[left] - offsets[owner[left]]
        strings["doc_id"], strings["text_key"] = ids[owner[left]], text_keys[owner[left]]
        on = np.flatnonzero(~gone & ~hot)
        columns = []
        for i in range(0, max(len(on), 1), SENT):
            k, at, a, b, t = (x[on[i : i + SENT]] for x in (key, anchor, first, last, text))
            where, begins = ranges_within(a, b - a + LENGTH)
            bounds = np.append(begins, len(where)).astype(np.int32)
            cut = pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer(bounds), pa.py_buffer(data[where])])
            columns = [
                pa.array(k.view(np.int64)), pa.array(np.full(len(k), g, np.int32)),
                pa.array(ids[t]), pa.array(text_keys[t]), pa.array(a - offsets[t]),
                pa.array((at - a).astype(np.int32)), pa.array((b - a + 1).astype(np.int32)), cut,
            ]
            yield pa.record_batch(columns, names=NAMES)
        text, first, n = (np.concatenate(x) for x in zip(*known, strict=True))
        local = packed_runs(ids[text], text_keys[text], first - offsets[text], n)
        rows = [(PACKED, g, local)] if len(local) else []
        rows += [(STRINGS, i, strings[at].tobytes()) for i, at in by_bucket(strings["hash"][:, 0], buckets)]
        for kind, spread, held in rows:
            spread = int(mix(np.array([spread + 1], U64)).view(np.int64)[0])
            row = [spread, g, 0, 0, 0, kind, 0, held]
            yield pa.record_batch([pa.array([v], c.type) for v, c in zip(row, columns, strict=True)], names=NAMES)

    return run


def packed_runs(ids, text_keys, starts, strings) -> bytes:
    """(doc_id, text_key, first, end) of runs of strings, neighbouring runs made one."""
    order = np.lexsort((starts, text_keys, ids))
    ids, text_keys, starts, ends = ids[order], text_keys[order], starts[order], (starts + strings)[order]
    opens = np.ones(len(ids), bool)
    opens[1:] = (ids[1:] != ids[:-1]) | (text_keys[1:] != text_keys[:-1]) | (starts[1:] > ends[:-1])
    closes = np.append(opens[1:], True) if len(ids) else opens
    rows = np.stack([ids[opens], text_keys[opens], starts[opens], ends[closes]], axis=1)
    return rows.astype("<i8").tobytes()


def preceded(same: np.ndarray, ids: np.ndarray, text_keys: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether an equal one starts in a smaller id, or earlier in the same document."""
    order = np.lexsort((starts, text_keys, ids, same))
    s, i, t = same[order], ids[order], text_keys[order]
    again = np.zeros(len(s), bool)
    again[1:] = s[1:] == s[:-1]
    heads = np.flatnonzero(~again)
    least = np.repeat(i[heads], np.diff(np.append(heads, len(s))))
    gone = i > least
    gone[1:] |= again[1:] & (i[1:] == i[:-1]) & (t[1:] == t[:-1])
    out = np.empty(len(s), bool)
    out[order] = gone
    return out


def column_rounds(key, before, strings, ids, text_keys, starts, pieces: pa.Array) -> np.ndarray:
    """Which strings of each piece go: one row per piece, one place per string.

    Pieces are sorted by key; ``before`` is the number of bytes before the anchor.
    """
    n = len(key)
    bytes_, offsets = np.frombuffer(pieces.buffers()[2], np.uint8), np.frombuffer(pieces.buffers()[1], np.int32)
    offsets = offsets[pieces.offset : pieces.offset + n + 1].astype(np.int64)
    sizes = np.diff(offsets)
    gone = np.zeros((n, PLACES), bool)
    collection = np.cumsum(np.diff(key, prepend=key[0]) != 0)
    opens = np.zeros(n, bool)
    opens[np.searchsorted(collection, np.arange(collection[-1] + 1))] = True
    order = np.arange(n)
    # A piece that has not begun or is over has the sign 0, which equals nothing.
    prefix = np.zeros(n + 1, np.int64)
    for column in range(int((sizes - before).max()) - 1, -int(before.max()) - 1, -1):
        place = column + before[order]
        inside = (place >= 0) & (place < sizes[order])
        sign = np.where(inside, bytes_[offsets[order] + np.where(inside, place, 0)].astype(np.int64) + 1, 0)
        moved = np.argsort(collection * 257 + sign, kind="stable")
        sign = sign[moved]
        pairs = np.zeros(n, bool)
        pairs[1:] = ~opens[1:] & (sign[1:] == sign[:-1]) & (sign[1:] > 0)
        to = np.flatnonzero(pairs)
        grown = np.zeros(n + 1, np.int64)
        if len(to):
            spans = np.stack([moved[to - 1] + 1, moved[to] + 1], axis=1).ravel()
            grown[to] = np.minimum.reduceat(prefix, spans)[::2] + 1
        order, prefix = order[moved], grown
        # Strings that start in this column: equal ones are neighbours.
        place = column + before[order]
        starting = (place >= 0) & (place < strings[order])
        if starting.any():
            same = np.cumsum(prefix[:n] < LENGTH)
            counts = np.bincount(same[starting], minlength=same[-1] + 1)
            look = np.flatnonzero(starting & (counts[same] > 1))
            if len(look):
                own = order[look]
                lost = preceded(same[look], ids[own], text_keys[own], starts[own] + place[look])
                gone[own[lost], place[look][lost]] = True
    return gone


def settle_pieces(rows: pa.Table) -> pa.RecordBatch:
    """Spans of strings that go, for whole collections."""
    key, g, ids, text_keys, starts, before, strings = (
        rows[c].combine_chunks().to_numpy(zero_copy_only=False) for c in NAMES[:-1]
    )
    cut = rows["piece"].combine_chunks()
    cut = cut.combine_chunks() if isinstance(cut, pa.ChunkedArray) else cut
    packed = np.flatnonzero(before == PACKED)
    all_gone = before < 0
    # Equal pieces of different groups: only those that no other precedes go on.
    have = np.flatnonzero(before >= 0)
    if len(have):
        codes = cut.take(pa.array(have)).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        all_gone[have] = preceded(codes, ids[have], text_keys[have], starts[have])
    left = np.flatnonzero(~all_gone)
    several = np.ones(len(left), bool)
    if len(left):
        _, code, n = np.unique(key[left], return_inverse=True, return_counts=True)
        several = n[code] > 1
    left = left[several]
    whole = np.flatnonzero(all_gone & (before >= 0))
    firsts, ends, owners = [starts[whole]], [(starts + strings)[whole]], [whole]
    if len(left):
        gone = column_rounds(
            key[left], before[left], strings[left], ids[left], text_keys[left], starts[left], cut.take(pa.array(left))
        )
        edges = np.diff(np.pad(gone, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        who, a = np.nonzero(edges == 1)
        _, b = np.nonzero(edges == -1)
        firsts.append(starts[left[who]] + a)
        ends.append(starts[left[who]] + b)
        owners.append(left[who])
    owner = np.concatenate(owners)
    told = [np.frombuffer(cut[int(i)].as_py(), "<i8").reshape(-1, 4) for i in packed]
    local = np.concatenate(told) if told else np.zeros((0, 4), np.int64)
    of = np.repeat(g[packed], [len(x) for x in told]).astype(np.int32)
    singly = np.flatnonzero(before == STRINGS)
    if len(singly):
        held = [np.frombuffer(cut[int(i)].as_py(), STRING) for i in singly]
        one = np.concatenate(held)
        lost = preceded(numbered(one["hash"]), one["doc_id"], one["text_key"], one["start"])
        of = np.append(of, np.repeat(g[singly], [len(x) for x in held])[lost].astype(np.int32))
        one = one[lost]
        local = np.concatenate([local, np.stack([one["doc_id"], one["text_key"], one["start"], one["start"] + 1], axis=1)])
    columns = [
        np.append(g[owner], of), np.append(ids[owner], local[:, 0]), np.append(text_keys[owner], local[:, 1]),
        np.append(np.concatenate(firsts), local[:, 2]), np.append(np.concatenate(ends), local[:, 3]),
    ]
    return pa.record_batch([pa.array(c) for c in columns], names=["g", "doc_id", "text_key", "first", "end"])


def settle_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for _, rows in runs_of(batches, "key"):
        held.append(rows)
        n += max(rows.num_rows, rows["piece"].nbytes // (2 * LENGTH))
        if n >= PIECES:
            yield settle_pieces(pa.concat_tables(held))
            held, n = [], 0
            give_back()
    if held:
        yield settle_pieces(pa.concat_tables(held))


def settle_packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, spans): the same, packed for the groups that wait for them."""
    for batch in settle_batches(batches):
        if batch.num_rows == 0:
            continue
        g = batch.column(0).to_numpy(zero_copy_only=False)
        values = [batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3, 4)]
        order = np.argsort(g, kind="stable")
        heads = np.flatnonzero(np.diff(g[order], prepend=-1))
        rows = [
            np.stack([v[order[a:b]] for v in values], axis=1).astype("<i8").tobytes()
            for a, b in zip(heads, np.append(heads[1:], len(g)).astype(int), strict=True)
        ]
        yield pa.record_batch(
            [pa.array(g[order][heads].astype(np.int32)), pa.array(rows, pa.binary())],
            names=["g", "spans"],
        )


def removals(docs: DataFrame, run, schema: str, others: Sequence[str] = ()) -> DataFrame:
    """``run(documents, data, offsets, removed)`` for every group, ``removed`` by byte."""
    dealt, buckets = deal(docs, others)
    keys = settle(shared_and_hot(meet(dealt, None, send_keys(buckets), COUNTED), HOT), "keys")
    pieces = meet(dealt, keys, send_pieces(buckets * STRING_BUCKETS), PIECE)
    sorted_ = pieces.repartition("key").sortWithinPartitions("key")
    found = settle(sorted_.mapInArrow(settle_packed, "g int, spans binary"), "spans")

    def finish(g, told: dict, documents: pa.Table) -> Iterator[pa.RecordBatch]:
        data, offsets = utf8(text_array(documents))
        rows = joined(told["spans"], "<i8").reshape(-1, 4)
        names = {}
        ids, text_keys = ids_of(documents), documents["text_key"].to_numpy()
        for i, name in enumerate(zip(ids.tolist(), text_keys.tolist(), strict=True)):
            names.setdefault(name, []).append(i)
        change = np.zeros(len(data) + 1, np.int64)
        order = np.lexsort((rows[:, 1], rows[:, 0]))
        rows = rows[order]
        heads = np.flatnonzero(np.any(np.diff(rows[:, :2], axis=0, prepend=rows[:1, :2] - 1) != 0, axis=1)) if len(rows) else []
        for a, b in zip(heads, np.append(heads, len(rows))[1:].astype(int), strict=True):
            for i in names.get((int(rows[a, 0]), int(rows[a, 1])), []):
                np.add.at(change, offsets[i] + rows[a:b, 2], 1)
                np.add.at(change, offsets[i] + rows[a:b, 3] + LENGTH - 1, -1)
        yield run(documents, data, offsets, np.cumsum(change[:-1]) > 0)

    return meet(dealt, found, finish, schema)


def digest_rows(documents: pa.Table, data, offsets, removed) -> pa.RecordBatch:
    n_bytes = np.diff(offsets)
    held = np.append(0, np.cumsum(removed))
    opens = removed.copy()
    opens[1:] &= ~removed[:-1]
    cuts = offsets[:-1][n_bytes > 0]
    opens[cuts] = removed[cuts]
    begun = np.append(0, np.cumsum(opens))
    kept = data[~removed].tobytes()
    at = offsets - held[offsets]
    digests = [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    return pa.record_batch(
        [
            documents["doc_id"].combine_chunks(), pa.array(n_bytes),
            pa.array(held[offsets[1:]] - held[offsets[:-1]]),
            pa.array(begun[offsets[1:]] - begun[offsets[:-1]]), pa.array(digests),
        ],
        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    )


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the digest of the remaining bytes."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return removals(docs, digest_rows, schema)


def text_rows(documents: pa.Table, data, offsets, removed) -> pa.RecordBatch:
    """Remaining texts; a character goes only if all its bytes do."""
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    if len(heads):
        whole = np.logical_and.reduceat(removed, heads)
        removed = np.repeat(whole, np.diff(np.append(heads, len(data))))
    kept = data[~removed]
    at = offsets - np.append(0, np.cumsum(removed))[offsets]
    texts = pa.Array.from_buffers(
        pa.string(), len(offsets) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(kept)]
    )
    return pa.record_batch(
        [documents["doc_id"].combine_chunks(), texts, documents["others"].combine_chunks()],
        names=["doc_id", "text", "others"],
    )


def remaining_texts(docs: DataFrame) -> DataFrame:
    """The documents with what remains of their texts; ``n_chars``, if there, is counted anew."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    if not others:
        return removals(docs, text_rows, "doc_id long, text string, others string").drop("others")
    kind = docs.select(F.struct(*others)).schema[0].dataType.simpleString()
    rest = removals(docs, text_rows, f"doc_id long, text string, others {kind}", others)
    columns = [F.col(c) if c in ("doc_id", "text") else F.col("others")[c].alias(c) for c in docs.columns]
    kept = rest.select(*columns)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in others else kept
