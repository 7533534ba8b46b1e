"""Operators 1, 8 and 9: word windows, byte strings, near-duplicates."""

from __future__ import annotations

import brute
import numpy as np
import pytest
from cases import plain, table

from ledgerloom.llm import groups, recompression, simhash, suffix_dedup


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("group_bytes", [1000, 1 << 22])
def test_word_windows(docs, rows, monkeypatch, group_bytes):
    monkeypatch.setattr(groups.deal, "__defaults__", ((), group_bytes))
    assert plain(recompression.digests(docs)) == ordered(brute.window_dedup(rows))


@pytest.mark.parametrize("group_bytes", [1000, 1 << 22])
def test_byte_strings(docs, rows, monkeypatch, group_bytes):
    monkeypatch.setattr(groups.deal, "__defaults__", ((), group_bytes))
    assert plain(suffix_dedup.digests(docs)) == ordered(brute.suffix_dedup(rows))


def test_near_duplicates(docs, rows):
    prints = [brute.fingerprint(t) for _, t in rows]
    low = brute.components(rows, prints)
    expected = [(d, f"{p:016x}", c) for (d, _), p, c in zip(rows, prints, low, strict=True)]
    assert plain(simhash.near_duplicates(docs)) == ordered(expected)


def test_other_columns_change_nothing(docs, clashing):
    for made in (recompression.digests, suffix_dedup.digests, simhash.near_duplicates):
        assert plain(made(clashing)) == plain(made(docs))


def test_no_documents(nothing):
    for made in (recompression.digests, suffix_dedup.digests, simhash.near_duplicates):
        assert made(nothing).count() == 0
    assert suffix_dedup.remaining_texts(nothing).count() == simhash.one_of_each(nothing).count() == 0


def test_one_very_long_text(spark):
    text = " ".join(f"w{i % 70_000}" for i in range(100_000))
    rows = [(1, text), (2, "new " + text[1000:3000])]
    assert plain(recompression.digests(table(spark, rows))) == brute.window_dedup(rows)
    assert plain(suffix_dedup.digests(table(spark, rows))) == brute.suffix_dedup(rows)


def test_repeated_rows_keep_their_text(spark):
    alone = {d: " ".join(f"{d}-{i}" for i in range(90)) for d in (5, None)}
    twice = alone[5] + " again " + alone[5]
    rows = [(5, alone[5]), (5, alone[5]), (None, alone[None]), (None, alone[None]), (2, "short"), (None, "other")]
    assert plain(suffix_dedup.digests(table(spark, rows))) == ordered(brute.suffix_dedup(rows))
    left = suffix_dedup.remaining_texts(table(spark, rows)).collect()
    assert ordered((r["doc_id"], r["text"]) for r in left) == ordered(rows)
    rows = [(7, twice), (7, twice), (9, alone[5])]
    assert plain(suffix_dedup.digests(table(spark, rows))) == ordered(brute.suffix_dedup(rows))


def test_hot_anchors_are_dealt_by_string(spark, docs, rows, monkeypatch):
    passage = " ".join(f"shared {i}" for i in range(40))
    hot = [(i, f"{'lead ' * (i % 7)}{i * 7919} {passage} {i * 104729} tail") for i in range(150)]
    hot += [(None, f"none {passage} none"), (3, f"other {passage} other"), hot[4]]
    most, meet = [], suffix_dedup.meet

    def met(dealt, answers, run, schema):
        out = meet(dealt, answers, run, schema)
        if schema == suffix_dedup.PIECE:
            most.append(out.groupBy("key").count().agg({"count": "max"}).first()[0])
        return out

    monkeypatch.setattr(suffix_dedup, "meet", met)
    monkeypatch.setattr(groups.deal, "__defaults__", ((), 4000))
    monkeypatch.setattr(suffix_dedup, "HOT", 20, raising=False)
    assert plain(suffix_dedup.digests(table(spark, hot))) == ordered(brute.suffix_dedup(hot))
    assert most[0] <= 40
    monkeypatch.setattr(suffix_dedup, "HOT", 0, raising=False)
    assert plain(suffix_dedup.digests(docs)) == ordered(brute.suffix_dedup(rows))


def test_long_runs_make_few_pieces(spark, monkeypatch):
    import pyarrow as pa

    from ledgerloom.llm.texts import utf8

    rng = np.random.default_rng(1)
    words = ["".join(map(chr, rng.integers(97, 123, n))) for n in (1, 2, 7, 31, 66, 68, 69, 70, 90)]
    texts = [w * (700 // len(w)) for w in words] + ["-" * 400, "ab" + "-" * 300 + "cd" + "-" * 150 + "é" * 120]
    texts += ["-" * 130, "-" * 130, words[3] * 9, words[3][5:] + words[3] * 9, "x" + "- " * 200 + "y" * 101]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "-" * 300)]
    for block in (1 << 19, 256):
        monkeypatch.setattr(suffix_dedup, "BLOCK", block)
        assert plain(suffix_dedup.digests(table(spark, rows))) == ordered(brute.suffix_dedup(rows))
    monkeypatch.undo()
    for unit in ("-", "ab", "abcdefg"):
        data, offsets = utf8(pa.array([unit * (3_000_000 // len(unit))]))
        told = {"shared": [], "hot": []}
        documents = pa.table({"doc_id": [1], "text_key": [1], "text": [unit * (3_000_000 // len(unit))]})
        keys = suffix_dedup.pieces_of(data, offsets)[0][0]
        assert len(keys) < 1000
        told["shared"] = [np.unique(keys).tobytes()]
        sent = sum(b.num_rows for b in suffix_dedup.send_pieces(1)(0, told, documents))
        assert sent < 1000


def test_recompression_names_equal_windows_alike(rows):
    import pyarrow as pa

    from ledgerloom.llm.texts import utf8

    names, first, _, _ = recompression.word_names(*utf8(pa.array([t for _, t in rows])))
    places = recompression.window_places(first)
    key, code = recompression.window_keys(names, first, places)
    seen = {}
    for place, c in zip(places, code, strict=True):
        window = tuple(names[place : place + 13].tolist())
        assert seen.setdefault(window, key[c]) == key[c]
    assert len(key) < len(places)


def test_index_finds_all_links_of_dense_runs(spark):
    rng = np.random.default_rng(0)
    codes = set()
    for base in rng.integers(0, 2**63, 6, dtype=np.uint64).tolist():
        for _ in range(150):
            code = base
            for bit in rng.integers(0, 64, rng.integers(0, 6)).tolist():
                code ^= 1 << bit
            codes.add(code)
    prints = sorted(codes)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(p,) for p in signed], "print long")
    root = {r["node"]: r["root"] for r in simhash.components(simhash.links(frame)).collect()}
    expected = brute.components([(i, "") for i in range(len(prints))], prints)
    ours, theirs = {}, {}
    for i, p in enumerate(signed):
        ours.setdefault(root.get(p, p), set()).add(i)
        theirs.setdefault(expected[i], set()).add(i)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_gray_neighbours_differ_in_one_bit():
    ranks = np.arange(1000, dtype=np.uint64)
    codes = simhash.gray_code(ranks)
    assert (np.bitwise_count(codes[1:] ^ codes[:-1]) == 1).all()
    assert (simhash.gray_rank(codes) == ranks).all()


def test_remaining_texts_keep_whole_characters_and_columns(docs, rows, clashing):
    left = suffix_dedup.remaining_texts(docs)
    assert left.columns == docs.columns and left.count() == len(rows)
    for r in left.collect():
        assert r["n_chars"] == len(r["text"])
    assert suffix_dedup.remaining_texts(clashing).columns == clashing.columns
    letters = "".join(chr(0x400 + i) for i in range(60))
    given = [(1, letters + "a"), (2, "b" + letters), (3, "c" + letters[:40])]
    both = {r["doc_id"]: r["text"] for r in suffix_dedup.remaining_texts(table(docs.sparkSession, given)).collect()}
    assert both == {1: letters + "a", 2: "b", 3: "c" + letters[:40]}


def test_one_of_each_group_stays(docs):
    expected = {}
    for r in simhash.grouped(docs).collect():
        if r["doc_id"] == r["component_id"]:
            row = (r["doc_id"], r["text_key"])
            expected[r["group"]] = min(row, expected.get(r["group"], row))
    stayed = simhash.one_of_each(docs)
    assert stayed.columns == docs.columns
    kept = stayed.select("doc_id", groups.text_key(stayed.text).alias("text_key")).collect()
    # Id 18 stands in two groups with two texts: a row of each stays.
    assert sorted(map(tuple, kept)) == sorted(expected.values())
