"""Operators 2 and 10: token counts, encoding and decoding."""

from __future__ import annotations

import base64
import random
import struct

import brute
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from cases import plain
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import byte_bpe, pretokens, token_counts

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

ODD = [
    "", None, "a" * 3000, " " * 700, "'s 're don't 'S !!'s 'r'v'l 'll'", "x  \n\n y\x1c\x85 z",
    "x <|endoftext|> y<|endoftext|>'s  <|endoftext|>", "<|endoftext", "\U0001f600 x́ ½ Ⅷ",
    "日本語 テキスト１２３", "\n",
]


def texts():
    rng = random.Random(2)
    made = ["".join(rng.choice("ab '\n\t!1srevmlé中́") for _ in range(60)) for _ in range(300)]
    made += ["".join(rng.choice("abcdeinorst") for _ in range(150)) for _ in range(60)]
    return ODD + made + ["".join(chr(rng.randrange(32, 0x3000)) for _ in range(40)) for _ in range(60)]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_counts_are_those_of_the_library():
    theirs = Tokenizer.from_file(JSON)
    expected = [len(e.ids) for e in theirs.encode_batch([t or "" for t in texts()], add_special_tokens=False)]
    assert token_counts.Counter(JSON).text_counts(pa.array(texts())).tolist() == expected


@pytest.mark.parametrize("chunk", [1, 7, 1024])
def test_chunks_change_nothing(monkeypatch, chunk):
    expected = pretokens.split(pa.array(texts()))
    monkeypatch.setattr(pretokens, "CHUNK", chunk)
    some = pretokens.split(pa.array(texts()))
    assert some.strings == expected.strings and (some.codes == expected.codes).all()


def test_small_memory_changes_nothing(monkeypatch):
    expected = token_counts.Counter(JSON).text_counts(pa.array(texts())).tolist()
    monkeypatch.setattr(token_counts, "REMEMBERED", 10)
    counter = token_counts.Counter(JSON)
    for _ in range(2):
        assert counter.text_counts(pa.array(texts())).tolist() == expected


def test_query_columns(docs, rows):
    theirs = Tokenizer.from_file(JSON)
    sizes = [len(theirs.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    expected = [(d, len((t or "").encode()), n, n > 50) for (d, t), n in zip(rows, sizes, strict=True)]
    assert plain(token_counts.count_tokens(docs, JSON, 50)) == sorted(expected, key=repr)


def test_ids_are_those_of_the_library(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 50)
    codec = byte_bpe.Codec(RANKS)
    for _ in range(2):
        ids = codec.encode(pa.array(texts()))
        for one, text in zip(ids.to_pylist(), texts(), strict=True):
            theirs = library.encode_ordinary(text or "")
            assert one == struct.pack(f"<{len(theirs)}I", *theirs)
    assert codec.decode(ids).to_pylist() == [(t or "").encode() for t in texts()]


def test_digests(docs, rows, library):
    expected = []
    for d, t in rows:
        ids = library.encode_ordinary(t or "")
        expected.append((d, len(ids), brute.sha(struct.pack(f"<{len(ids)}I", *ids)), brute.sha(t or "")))
    found = byte_bpe.digests(byte_bpe.encode_documents(docs, RANKS))
    assert plain(found) == sorted(expected, key=repr)


def test_no_documents_and_null_ids(nothing, docs, clashing):
    assert byte_bpe.digests(byte_bpe.encode_documents(nothing, RANKS)).count() == 0
    assert token_counts.count_tokens(nothing, JSON, 5).count() == 0
    null = docs.limit(2).select(byte_bpe.decode(F.lit(None).cast("binary"), RANKS).alias("t"))
    assert [bytes(r["t"]) for r in null.collect()] == [b"", b""]
    assert plain(token_counts.count_tokens(clashing, JSON, 5)) == plain(token_counts.count_tokens(docs, JSON, 5))
