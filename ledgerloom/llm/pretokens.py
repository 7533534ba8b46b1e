"""Cuts texts into pre-tokens with a compiled finite-state machine.

The machine reads classes of characters and follows the splitting pattern of byte-level
BPE: contractions, and runs of letters, digits or other signs with one space before them,
and white space whose last character is left to what follows. Each transition may mark
that a pre-token begins at the character just read, or at the one before it (when white
space or a half-read contraction has to be given back).

A column of texts is one stream with an end sign after each text. The stream is cut into
chunks of equal length without regard to texts. What a chunk does to the machine is a map
from states to states; all maps that can arise are listed when the machine is compiled,
so a chunk's map is one number, found for all chunks side by side, character by
character. A parallel prefix scan composes the maps, which gives the state in which each
chunk begins; a second pass then marks the cuts. Nothing depends on where chunks begin.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

from ledgerloom.llm.texts import utf8

# Classes of characters.
LETTER, ENDS, R, V, L, E, DIGIT, SIGN, QUOTE, SPACE, BLANK, SPECIAL, INSIDE, END = range(14)
N_CLASSES = 14
# The letters that follow an apostrophe in the splitting pattern.
SINGLE = "stmd"
PAIRS = {R: "re", V: "ve", L: "ll"}

# States: fresh (whatever comes begins a pre-token), in letters, in digits, in signs, after
# an apostrophe, after an apostrophe and r, v or l, and in white space of one or more
# characters, the last one a space or another.
FRESH, IN_L, IN_N, IN_S, APO, APO_R, APO_V, APO_L, SP1, BL1, SP2, BL2 = range(12)
N_STATES = 12
# Marks: a pre-token begins here; one begins at the character before.
HERE, BEFORE = 1, 2

CHUNK = 1024
LETTERS = (LETTER, ENDS, R, V, L, E)


def transitions() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks by state and class."""
    to = np.zeros((N_STATES, N_CLASSES), np.uint8)
    marks = np.zeros((N_STATES, N_CLASSES), np.uint8)
    opened = {SIGN: IN_S, QUOTE: APO, SPACE: SP1, BLANK: BL1, DIGIT: IN_N, SPECIAL: FRESH, END: FRESH}
    opened |= dict.fromkeys(LETTERS, IN_L)
    for state in range(N_STATES):
        for cls, target in opened.items():
            to[state, cls], marks[state, cls] = target, HERE
        to[state, INSIDE] = FRESH

    def goes_on(state: int, classes: tuple[int, ...], target: int) -> None:
        to[state, list(classes)] = target
        marks[state, list(classes)] = 0

    goes_on(IN_L, LETTERS, IN_L)
    goes_on(IN_N, (DIGIT,), IN_N)
    goes_on(IN_S, (SIGN, QUOTE), IN_S)
    goes_on(APO, (SIGN, QUOTE), IN_S)
    goes_on(APO, (ENDS,), FRESH)
    for cls, state in ((R, APO_R), (V, APO_V), (L, APO_L)):
        goes_on(APO, (cls,), state)
        to[state], marks[state] = to[IN_L], marks[IN_L] | BEFORE
        goes_on(state, (L if cls == L else E,), FRESH)
    # White space: a space before anything else belongs to it, another blank doesn't.
    goes_on(SP1, LETTERS, IN_L)
    goes_on(SP1, (DIGIT,), IN_N)
    goes_on(SP1, (SIGN, QUOTE), IN_S)
    for state in (SP1, BL1, SP2, BL2):
        goes_on(state, (SPACE,), SP2)
        goes_on(state, (BLANK,), BL2)
    shown = (*LETTERS, DIGIT, SIGN, QUOTE)
    for state, like in ((SP2, SP1), (BL2, BL1)):
        for cls in shown:
            to[state, cls], marks[state, cls] = to[like, cls], marks[like, cls] | BEFORE
    return to, marks


@dataclass
class Machine:
    classes: np.ndarray  # of each code point
    to: np.ndarray  # state and class, flat
    marks: np.ndarray
    maps: np.ndarray  # all maps from states to states that can arise; map 0 changes nothing
    read: np.ndarray  # map and class, flat: the map with one more character read
    then: np.ndarray  # first map, second map: both, one after the other


@lru_cache(maxsize=1)
def machine() -> Machine:
    to, marks = transitions()
    every = "".join(chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000)
    classes = np.full(sys.maxunicode + 1, SIGN, np.uint8)
    for cls, runs in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (BLANK, r"\s+")):
        for match in regex.finditer(runs, every):
            points = np.frombuffer(match.group().encode("utf-32-le"), np.uint32)
            classes[points] = cls
    classes[ord(" ")], classes[ord("'")], classes[ord("e")] = SPACE, QUOTE, E
    classes[[ord(c) for c in SINGLE]] = ENDS
    for cls, pair in PAIRS.items():
        classes[ord(pair[0])] = cls
    listed = {tuple(range(N_STATES)): 0}
    order = list(listed)
    read = []
    for one in order:
        for cls in range(N_CLASSES):
            after = tuple(int(to[s, cls]) for s in one)
            if after not in listed:
                listed[after] = len(order)
                order.append(after)
            read.append(listed[after])
    maps = np.array(order, np.uint8)
    # Composed maps are in the list too: a chunk's map is that of its characters.
    then = np.array(
        [[listed[tuple(int(b[s]) for s in a)] for b in maps] for a in maps], np.uint16
    )
    return Machine(classes, to.ravel(), marks.ravel(), maps, np.array(read, np.uint16), then)


def begins(classes: np.ndarray) -> np.ndarray:
    """Whether a pre-token begins at each character of a stream that starts fresh."""
    m = machine()
    n_chunks = -(-len(classes) // CHUNK)
    padded = np.full(n_chunks * CHUNK, END, np.uint8)
    padded[: len(classes)] = classes
    columns = np.ascontiguousarray(padded.reshape(n_chunks, CHUNK).T)
    done = np.zeros(n_chunks, np.uint16)
    for column in columns:
        done = m.read[done * np.uint16(N_CLASSES) + column]
    step = 1
    while step < n_chunks:
        done[step:] = m.then[done[:-step], done[step:]]
        step *= 2
    state = np.zeros(n_chunks, np.uint8)
    state[1:] = m.maps[done[:-1], FRESH]
    marks = np.empty_like(columns)
    for column, mark in zip(columns, marks, strict=True):
        at = state * np.uint8(N_CLASSES) + column
        mark[:] = m.marks[at]
        state = m.to[at]
    flat = marks.T.ravel()[: len(classes)]
    begin = (flat & HERE).astype(bool)
    begin[:-1] |= (flat[1:] & BEFORE).astype(bool)
    return begin


@dataclass
class PreTokens:
    """Distinct pre-tokens of a column of texts, and where they stand.

    ``codes`` has a number into ``strings`` for each place in the stream; the place of
    the sign that ends text ``i`` is ``ends[i]`` and counts for nothing.
    """

    strings: list[bytes]
    codes: np.ndarray
    ends: np.ndarray


def special_places(data: bytes, specials: tuple[bytes, ...]) -> list[tuple[int, int]]:
    """Begin and end of special strings, leftmost first, the longest where two begin."""
    if not any(s in data for s in specials):
        return []
    either = b"|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True))
    return [m.span() for m in regex.finditer(either, data)]


def split(texts: pa.Array, specials: tuple[bytes, ...] = ()) -> PreTokens:
    """Pre-tokens of whole texts; ``specials`` are pre-tokens of their own wherever they stand."""
    data, offsets = utf8(texts)
    stream = np.insert(data, offsets[1:], np.uint8(10))
    end_bytes = offsets[1:] + np.arange(len(offsets) - 1)
    raw = stream.tobytes()
    decoded = raw.decode("utf-8", "replace")
    points = np.frombuffer(decoded.encode("utf-32-le", "replace"), np.uint32)
    first_bytes = np.flatnonzero((stream & 0xC0) != 0x80)
    if len(first_bytes) != len(points):
        raise ValueError("a text is not valid UTF-8")
    classes = machine().classes[points]
    classes[np.searchsorted(first_bytes, end_bytes)] = END
    for start, end in special_places(raw, specials):
        a, b = np.searchsorted(first_bytes, [start, end])
        if not (classes[a:b] == END).any():
            classes[a], classes[a + 1 : b] = SPECIAL, INSIDE
    cuts = first_bytes[begins(classes)]
    bounds = np.append(cuts, len(raw)).astype(np.int32)
    pieces = pa.Array.from_buffers(
        pa.binary(), len(cuts), [None, pa.py_buffer(bounds), pa.py_buffer(raw)]
    ).dictionary_encode()
    codes = pieces.indices.to_numpy(zero_copy_only=False)
    return PreTokens(pieces.dictionary.to_pylist(), codes, np.searchsorted(cuts, end_bytes))
