"""Verified near copies against all pairs."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from cases import table

from ledgerloom.llm import near_copies, simhash


def changed(rng, words, n):
    out = list(words)
    for at in rng.sample(range(len(out)), n):
        out[at] = f"new{rng.randrange(10**6)}"
    return out


def partition(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["group"], []).append((r["doc_id"], r["text_key"]))
    return sorted((sorted(rows, key=repr) for rows in out.values()), key=repr)


def groups_of(rows):
    sets = [brute.shingle_set(t) for _, t in rows]
    return brute.linked(rows, lambda i, j: brute.similar(sets[i], sets[j]) >= 0.8)


def test_near_copies_are_found(spark):
    """Pairs alone: all other texts are of random words."""
    rng, rows, pairs = random.Random(11), [], {}
    for case in [(100, 1), (300, 3), (1000, 5), (100, 2), (300, 6)]:
        for _ in range(100):
            words = [f"w{rng.randrange(5000)}" for _ in range(case[0])]
            one, two = " ".join(words), " ".join(changed(rng, words, case[1]))
            at = len(rows)
            rows += [(at, one), (at + 1, two)]
            if brute.similar(brute.shingle_set(one), brute.shingle_set(two)) >= 0.8:
                pairs.setdefault(case, []).append(at)
    found = {r["doc_id"]: r["component_id"] for r in near_copies.grouped(table(spark, rows)).collect()}
    assert len(pairs) == 5
    for case, firsts in pairs.items():
        assert sum(found[d + 1] == d for d in firsts) >= 0.9 * len(firsts), case
    # What is not similar is not joined.
    alike = {d + 1 for firsts in pairs.values() for d in firsts}
    assert all(c == d or (d in alike and c == d - 1) for d, c in found.items())


def test_odd_texts(docs, rows, clashing, nothing):
    made = near_copies.grouped(docs).collect()
    assert len(made) == len(rows)
    # Every group lies within one of all pairs; texts without words are one group.
    true = {}
    for (doc, text), c in zip(rows, groups_of(rows), strict=True):
        true.setdefault((doc, c), text)
    assert {(r["doc_id"], r["component_id"]) for r in made if r["doc_id"] is not None} <= set(true) | {
        (r["doc_id"], r["doc_id"]) for r in made
    }
    blank = [d for d, t in rows if not brute.words(t)]
    assert {r["component_id"] for r in made if r["doc_id"] in blank} == {min(blank)}
    stayed = simhash.one_of_each(clashing, near_copies.grouped)
    assert stayed.columns == clashing.columns
    assert stayed.count() == len(partition(near_copies.grouped(docs)))
    assert simhash.one_of_each(nothing, near_copies.grouped).count() == 0


def test_order_of_rows_does_not_matter(docs):
    again = docs.orderBy(docs.text.desc()).repartition(7)
    assert partition(near_copies.grouped(docs)) == partition(near_copies.grouped(again))


def test_one_text_with_many_near_copies(spark):
    rng = random.Random(3)
    words = [f"w{rng.randrange(5000)}" for _ in range(150)]
    rows = [(i, " ".join(changed(rng, words, 1) if i else words)) for i in range(400)]
    rows += [(1000 + i, " ".join(f"v{rng.randrange(5000)}" for _ in range(150))) for i in range(200)]
    long = "tale " * 3 + " ".join(f"u{i}" for i in range(100_000))
    rows += [(2000, long), (2001, long + " end")]
    made = near_copies.grouped(table(spark, rows)).collect()
    low = {r["doc_id"]: r["component_id"] for r in made}
    assert sum(low[i] == 0 for i in range(400)) >= 396
    assert all(low[i] == i for i in range(1000, 1200))
    assert low[2001] == low[2000] == 2000


@pytest.mark.parametrize("n", [20, 700])
def test_a_run_joins_what_is_near(n):
    rng = np.random.default_rng(n)
    codes = rng.integers(0, 2**63, (5, 2), dtype=np.uint64)[rng.integers(0, 5, n)]
    for _ in range(9):
        codes[np.arange(n), rng.integers(0, 2, n)] ^= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    codes = codes[np.argsort(simhash.gray_rank(codes[:, 0]))]
    found = near_copies.run_candidates(np.zeros(n, np.int64), codes)
    differ = np.bitwise_count(codes[found[:, 0]] ^ codes[found[:, 1]]).sum(axis=1)
    assert (differ == found[:, 2]).all() and (differ <= near_copies.FURTHEST).all()
    rows = [(i, "") for i in range(n)]
    whole = brute.components(
        rows, [int(a) << 64 | int(b) for a, b in codes], near_copies.FURTHEST
    )
    root = list(range(n))
    for a, b, _ in sorted(found.tolist()):
        x, y = root[a], root[b]
        assert x != y  # a spanning forest has no pair too many
        root = [min(x, y) if r in (x, y) else r for r in root]
    low = {}
    for i, r in enumerate(root):
        low.setdefault(r, i)
    assert [low[r] for r in root] == whole
    assert len(found) == n - len(set(whole))


def test_front_grows_with_the_number_of_texts():
    few, many = near_copies.front_and_orders(1000), near_copies.front_and_orders(2**32)
    assert few[0] == 14 and len(few[1]) == 64
    assert many[0] == 24 and len(many[1]) == 466
