"""Inputs of the tests of the text operators."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def passages(seed=5):
    """Texts with shared passages, near copies, runs, odd letters, nulls and repeats."""
    rng = random.Random(seed)
    common = ["a", "b", "c", "dd", "é", "ff", "中"]
    shared = [[rng.choice([*common, f"x{rng.randrange(50)}"]) for _ in range(90)] for _ in range(5)]
    texts = []
    for i in range(60):
        text = [rng.choice(common) for _ in range(rng.randrange(0, 40))]
        for _ in range(rng.randrange(0, 3)):
            a = rng.randrange(0, 50)
            text += rng.choice(shared)[a : rng.randrange(a, 90)]
            if rng.random() < 0.3:
                text[rng.randrange(len(text) or 1) : 1] = ["Z"]
        texts.append(" \n"[i % 2].join(text) + ("\t" if i % 3 else ""))
    texts += ["a " * 300, "a " * 12, "a " * 13, "a b " * 60, "b a " * 40, "a a b " * 30]
    texts += ["x" * 500, "x" * 99, "x" * 100, "abcdefg" * 60, "cdefgab" * 30, "", " \t\n", None]
    texts += [texts[3], texts[3], "The a b c d e f g", "the A b c d e f g"]
    return [(i * 3, t) for i, t in enumerate(texts)]


def table(spark, rows):
    """Documents, with columns named like those the operators make themselves."""
    full = [(d, t, "en", f"s{(d or 0) % 4}", len(t or "")) for d, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def plain(df):
    return sorted(map(tuple, df.collect()), key=repr)
