"""Byte-level BPE through a sentencepiece model that is written from the vocabulary.

A rank file lists byte strings with their ranks. Every byte is mapped to one character,
so that a byte string becomes a piece; its score is the negative rank, so that the
lowest rank merges first, as the rank file wants it. The model file has no other parts
than the pieces, identity normalisation and the model kind, and is serialised here,
field by field. Nothing is trained.

A text is cut into pre-tokens by the splitting pattern (see ``pretokens``). Each is encoded on its own: one that the
vocabulary holds whole is that token, the others are merged by the model. Decoding looks
every id up in the vocabulary and joins the bytes.

Empty and null texts have no ids and decode to no bytes. The functions work on single
values, so repeated rows, ties and other columns don't matter.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.pretokens import split
from ledgerloom.llm.texts import give_back, ranges_within, slices

# Bytes become the characters from here on, none of which is white space or combines.
FIRST_CHARACTER = 0x100
TO_CHARACTERS = {b: chr(FIRST_CHARACTER + b) for b in range(256)}

# Parts pre-tokens that are encoded together; stands for no byte.
PARTS = "\x01"

# Bytes of text, or of ids, that are worked on at once.
SLICE_BYTES = 2 << 20
# Encoded pre-tokens a worker remembers; a full memory is emptied.
REMEMBERED = 100_000
# Bytes of pre-tokens that the model gets together.
TOGETHER = 1 << 16
# Only shorter pre-tokens are remembered.
LONGEST_REMEMBERED = 64


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file, by rank."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    strings = [b""] * len(pairs)
    for string, rank in pairs:
        strings[int(rank)] = base64.b64decode(string)
    return strings


def varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def number(field: int, n: int) -> bytes:
    return varint(field << 3) + varint(n)


def block(field: int, content: bytes) -> bytes:
    return varint(field << 3 | 2) + varint(len(content)) + content


def serialise(strings: list[bytes]) -> bytes:
    """A sentencepiece model whose piece ``i`` is ``strings[i]``; the last one is unknown.

    Fixed values, the fields of the public model format: pieces 1 (text 1, score 2, kind
    3: 1 normal, 2 unknown), trainer 2 (kind 3: 2 is BPE; size 4; ids of unknown, begin,
    end and padding 40 to 43), normaliser 3 (name 1; dummy prefix 3, white space removed
    4 and escaped 5).
    """
    pieces = [
        block(1, block(1, characters(s).encode()) + b"\x15" + struct.pack("<f", -i) + number(3, 1))
        for i, s in enumerate(strings)
    ]
    pieces.append(block(1, block(1, b"<unk>") + b"\x15" + struct.pack("<f", 0) + number(3, 2)))
    n = len(strings)
    trainer = number(3, 2) + number(4, n + 1) + number(40, n)
    trainer += number(41, -1) + number(42, -1) + number(43, -1)
    normaliser = block(1, b"identity") + number(3, 0) + number(4, 0) + number(5, 0)
    return b"".join(pieces) + block(2, trainer) + block(3, normaliser)


def characters(string: bytes) -> str:
    return string.decode("latin-1").translate(TO_CHARACTERS)


class Codec:
    """Encoder and decoder for one vocabulary; built once per worker."""

    def __init__(self, path: str):
        strings = read_ranks(path)
        self.unknown = len(strings)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(strings))
        self.whole = {s: i for i, s in enumerate(strings)}
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        self.lengths = np.array([len(s) for s in strings])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.known: dict[bytes, bytes] = {}  # ids as little-endian bytes

    def merged(self, strings: list[bytes]) -> list[bytes]:
        """Ids of pre-tokens that the vocabulary doesn't hold whole.

        Many are given to the model at once, parted by a character that is no piece, so
        that nothing merges across it and its unknown id parts the ids again.
        """
        ids = np.array(self.model.encode(PARTS.join(map(characters, strings))), "<u4")
        signs = np.flatnonzero(ids == self.unknown)
        line = ids.tobytes()
        begins = [0, *((signs + 1) * 4).tolist()]
        ends = [*(signs * 4).tolist(), len(line)]
        return [line[a:b] for a, b in zip(begins, ends, strict=True)]

    def learn(self, new: list[bytes]) -> None:
        rest = []
        for s in new:
            if s in self.whole:
                self.known[s] = struct.pack("<I", self.whole[s])
            else:
                rest.append(s)
        at = 0
        while at < len(rest):
            to, size = at, 0
            while to < len(rest) and size < TOGETHER:
                size += len(rest[to])
                to += 1
            self.known.update(zip(rest[at:to], self.merged(rest[at:to]), strict=True))
            at = to

    def encode(self, texts: pa.Array) -> pa.Array:
        """Ids of every text as little-endian bytes."""
        found = split(texts)
        if len(self.known) > REMEMBERED:
            self.known = {}
        self.learn([s for s in found.strings if s not in self.known])
        ids = [self.known[s] for s in found.strings]
        for s in found.strings:
            if len(s) > LONGEST_REMEMBERED:
                del self.known[s]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        taken = lengths[found.codes]
        taken[found.ends] = 0
        where, _ = ranges_within((np.cumsum(lengths) - lengths)[found.codes], taken)
        return binaries(flat[where], np.cumsum(taken)[found.ends] * 4)

    def decode(self, ids: pa.Array) -> pa.Array:
        """The bytes of the ids of every text."""
        data, offsets = raw(ids)
        numbers = data.view("<u4")
        lengths = self.lengths[numbers]
        where, _ = ranges_within(self.starts[numbers], lengths)
        ends = np.append(0, np.cumsum(lengths))[offsets[1:] // 4]
        return binaries(self.data[where], ends)


def raw(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a binary column; null is empty."""
    whole = pc.fill_null(values.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]].copy(), offsets - offsets[0]


def binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column from one array and the byte where each value ends."""
    offsets = np.append(0, ends).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    )


def in_slices(values: pa.Array, most_bytes: int, work: Callable[[pa.Array], pa.Array]) -> pa.Array:
    parts = [work(values.slice(a, b - a)) for a, b in slices(values, most_bytes)]
    give_back()
    return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(text: Column, path: str) -> Column:
    """Ids of a text as a binary column of little-endian unsigned 32-bit numbers."""

    @F.arrow_udf("binary")
    def ids(texts: pa.Array) -> pa.Array:
        return in_slices(texts, SLICE_BYTES, codec(path).encode)

    return ids(text)


def decode(ids: Column, path: str) -> Column:
    """The bytes that ids stand for, as a binary column."""

    @F.arrow_udf("binary")
    def decoded(given: pa.Array) -> pa.Array:
        return in_slices(given, SLICE_BYTES, codec(path).decode)

    return decoded(ids)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and the decoded bytes of every whole text."""
    with_ids = docs.select("doc_id", encode(F.col("text"), path).alias("ids"))
    return with_ids.select("doc_id", "ids", decode(F.col("ids"), path).alias("decoded"))


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and hex digests of the ids and of the decoded bytes."""
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
