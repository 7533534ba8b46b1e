"""Operators 11 and 12: chat formatting and the trie of conversation prefixes."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import chat, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
BITS = ["[INST]", "[/INST]", "[SYS]", "[/SYS]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[TEXT]", "[/TEXT]"]
BITS += ["[\\INST]", "[\\\\/TEXT]", "<\\s>", "<\\\\/s>", "[", "<", "\\", "INST]", "s>", "/", "é", "中", "a b", "\n", "", "$1"]


def awkward_rows():
    rng = random.Random(3)

    def said():
        return "".join(rng.choice(BITS) for _ in range(rng.randrange(0, 8)))

    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 7)):
            role = rng.choice(["user", "assistant", "system", "tool", "", None, said()])
            rows.append((conv, rng.choice([turn, turn, None]), role, rng.choice([said(), said(), None])))
    return [*rows, rows[0], (None, 1, "assistant", "x </s>"), (None, 0, "user", "y")]


def by_conversation(rows, key):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns, key=key)] for c, turns in found.items()}


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def escape(text):
    return re.sub(r"(\[)(?=\\*/?(?:INST|SYS|ROLE|TEXT)\])|(<)(?=\\*/?s>)", lambda m: m[0] + "\\", text)


def test_formatted_text_reads_back(awkward):
    expected = by_conversation(awkward_rows(), None)
    made = {r["conv_id"]: r for r in chat.format_conversations(awkward).collect()}
    assert made.keys() == expected.keys()
    marks = {"user": ("[INST]", "[/INST]"), "system": ("[SYS]", "[/SYS]"), "assistant": ("<s>", "</s>")}
    for conv, turns in expected.items():
        whole, spans = "", []
        for role, text in turns:
            opening, closing = marks.get(role, (f"[ROLE]{escape(role)}[/ROLE][TEXT]", "[/TEXT]"))
            start = len((whole + opening).encode())
            whole += opening + escape(text) + closing
            if role == "assistant":
                spans.append((start, start + len(escape(text).encode())))
        assert made[conv]["formatted"] == whole
        assert [tuple(s) for s in made[conv]["loss_spans"]] == spans
    read = chat.format_conversations(awkward).select("conv_id", chat.read_back(F.col("formatted")).alias("turns"))
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in read.collect()} == expected


def test_digests_of_conversations(awkward):
    expected = by_conversation(awkward_rows(), None)
    rows = chat.digests(chat.format_conversations(awkward)).collect()
    assert len(rows) == len(expected)
    for r in rows:
        turns = expected[r["conv_id"]]
        loss = "".join(text for role, text in turns if role == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), sha(loss))


@pytest.mark.parametrize(
    "text",
    ["[INST]a", "a[/INST]", "[INST]a[/SYS]", "[INST]a[INST][/INST]", "x[INST]a[/INST]", "[INST]a[/INST]x", "[TEXT]a[/TEXT]",
     "[ROLE]a[/ROLE]", "[ROLE]a[/ROLE][INST]b[/INST]", "[ROLE]a[/ROLE][ROLE]b[/ROLE][TEXT]c[/TEXT]", "</s><s>", "a"],
)
def test_the_parser_refuses_what_the_grammar_does_not_allow(spark, text):
    assert spark.range(1).select(chat.read_back(F.lit(text))).first()[0] is None


def test_only_conflicting_turns_are_escaped(spark):
    rows = [(1, 0, "user", "a [b] <c> \\"), (1, 1, "assistant", "[INST]")]
    made = chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).first()
    assert made["formatted"] == "[INST]a [b] <c> \\[/INST]<s>[\\INST]</s>"


def test_a_long_conversation_and_a_long_text(spark):
    rows = [(1, i, ["user", "assistant"][i % 2], f"t{i} </s>") for i in range(5000)] + [(2, 0, "user", "[INST]" * 200_000)]
    found = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert found[1]["n_turns"] == 5000 and found[2]["formatted_chars"] == 13 + 7 * 200_000
    assert found[2]["turns_sha256"] == sha("user\n" + "[INST]" * 200_000 + "\n")


def test_formatting_uses_no_python_and_ignores_other_columns(awkward):
    plan = chat.digests(chat.format_conversations(awkward))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    names = ["head", "body", "tail", "before", "block", "span", "turns", "formatted", "fits", "placed"]
    clashing = awkward.withColumns({n: F.lit("clash") for n in names})
    assert sorted(map(str, chat.format_conversations(clashing).collect())) == sorted(map(str, chat.format_conversations(awkward).collect()))
    assert chat.digests(chat.format_conversations(awkward.limit(0))).count() == 0


# Operator 12


def chats():
    """Families of conversations with shared turns, ties, nulls and repeated rows."""
    rng = random.Random(8)
    rows = []
    for conv in [*range(0, 60), *range(100, 130), 205, 217, 399, -5, -120]:
        for turn in range(rng.randrange(1, 9)):
            text = rng.choice(["hi", "é", "yes", "", None]) if rng.random() < 0.8 else f"t{rng.randrange(9)}"
            rows.append((conv, rng.choice([turn, turn, turn, None]), rng.choice(["user", "assistant", None]), text))
    return [*rows, rows[3], rows[3], (None, 0, "user", "lost")]


def brute_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            key = hashlib.sha256(f"{len(role or '')}:{role or ''}:{text or ''}".encode()).digest()
            turns[conv].append((turn is not None, turn or 0, key, role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    made = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        made[c] = tuple(own.get(first, [])[:h] + said[h:])
    nodes = defaultdict(list)
    for c, said in made.items():
        for d in range(len(said) + 1):
            nodes[said[:d]].append(c)
    out = []
    for seq, convs in nodes.items():
        children = {s for s in nodes if len(s) == len(seq) + 1 and s[: len(seq)] == seq}
        below = [s for s in nodes if s[: len(seq)] == seq]
        leaves = [s for s in below if not any(len(x) == len(s) + 1 and x[: len(s)] == s for x in below)]
        saved = sum((len(nodes[s]) - 1) * len(s[-1][1]) for s in below if s)
        ends = ",".join(str(c) for c in sorted(c for c in convs if made[c] == seq))
        parent = min(nodes[seq[:-1]]) if seq else None
        out.append((min(convs), len(seq), parent, len(convs), len(children), len(leaves), saved, sha(ends)))
    return sorted(out, key=repr)


def trie_rows(df):
    made = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.numbered(df))).drop("node")
    return sorted(map(tuple, made.collect()), key=repr)


@pytest.mark.parametrize(("shard", "most_turns"), [(1024, 1 << 16), (7, 1 << 16), (1, 1 << 16), (64, 3), (2, 0)])
def test_trie_against_all_prefixes(spark, monkeypatch, shard, most_turns):
    monkeypatch.setattr(prefix_trie, "SHARD", shard)
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", most_turns)
    assert trie_rows(spark.createDataFrame(chats(), SCHEMA)) == brute_trie(chats())


def test_trie_of_many_equal_conversations_and_a_long_one(spark):
    rows = [(c, t, "user", f"w{t}") for c in range(300) for t in range(7)] + [(900, t, "user", f"x{t % 3}") for t in range(400)]
    assert trie_rows(spark.createDataFrame(rows, SCHEMA)) == brute_trie(rows)


def test_trie_without_conversations_and_with_other_columns(spark):
    df = spark.createDataFrame(chats(), SCHEMA)
    assert trie_rows(df.limit(0)) == []
    names = ["place", "key", "chars", "n", "node", "parent", "depth", "shard", "pre", "last", "first", "h"]
    assert trie_rows(df.withColumns({n: F.lit("clash") for n in names})) == trie_rows(df)


def test_rebuilt_conversations_may_have_no_turns(spark):
    # 105 takes its head from 100, which is absent, and has no turns beyond it.
    lost = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(lost, 0, "user", "a"), (lost, 1, "user", "b")]
    assert trie_rows(spark.createDataFrame(rows, SCHEMA)) == [(lost, 0, None, 1, 0, 1, 0, sha(str(lost)))]
