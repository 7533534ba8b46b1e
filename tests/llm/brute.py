"""Plain versions of the text operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall(text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def earlier(a, b):
    """Whether id ``a`` is smaller; null comes last."""
    return a is not None and (b is None or a < b)


def window_dedup(rows, size=13):
    least = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            if key not in least or earlier(doc, least[key]):
                least[key] = doc
    out = []
    for doc, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if earlier(least[tuple(w[i : i + size])], doc):
                gone[i : i + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc, len(w), sum(gone), sha(kept)))
    return out


def gone_bytes(rows, size=100):
    """For each row, which bytes go."""
    places = {}
    for r, (_, text) in enumerate(rows):
        data = (text or "").encode()
        for i in range(len(data) - size + 1):
            places.setdefault(data[i : i + size], []).append((r, i))
    out = [bytearray(len((t or "").encode())) for _, t in rows]
    for found in places.values():
        ids = [rows[r][0] for r, _ in found]
        for n, (r, i) in enumerate(found):
            own = any(q == r and j < i for q, j in found[:n])
            if own or any(earlier(d, rows[r][0]) for d in ids):
                out[r][i : i + size] = b"\1" * size
    return out


def suffix_dedup(rows, size=100):
    out = []
    for (doc, text), gone in zip(rows, gone_bytes(rows, size), strict=True):
        data = (text or "").encode()
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(data), sum(gone), spans, sha(kept)))
    return out


def fingerprint(text):
    w = words((text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def shingle_set(text, size=5):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def similar(a, b):
    """Common shingles by all shingles; texts without words are alike."""
    return len(a & b) / len(a | b) if a or b else 1.0


def components(rows, prints, furthest=3):
    """The smallest id reachable from each row."""
    return linked(rows, lambda i, j: (prints[i] ^ prints[j]).bit_count() <= furthest)


def linked(rows, near):
    """The smallest id reachable from each row over pairs that are ``near``."""
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if near(i, j):
                root[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        low[r] = doc if r not in low or earlier(doc, low[r]) else low[r]
    return [low[find(i)] for i in range(len(rows))]
