"""Splitting many texts into pretokens at once, with arrays of code points.

A machine of four character classes (space, letter, number, other) decides
where pretokens begin; its transitions depend on a few neighbours only, so all
positions of all texts are decided together.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np

from . import words

SPACE, LETTER, NUMBER, OTHER = range(4)
_TOP = 0x110000


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of each code point."""
    import regex

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, _TOP)]))
    table = np.full(_TOP, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            a, b = (x if x < 0xD800 else x + 0x800 for x in (m.start(), m.end() - 1))
            table[a : b + 1] = kind
    return table


@lru_cache(1)
def lower() -> np.ndarray:
    """The lower case of each code point that has one of a single code point."""
    table = np.arange(_TOP, dtype=np.uint32)
    for x in range(_TOP):
        if not 0xD800 <= x < 0xE000 and len(y := chr(x).lower()) == 1:
            table[x] = ord(y)
    return table


@lru_cache(1)
def _mixed() -> np.ndarray:
    return words.mix(np.arange(_TOP, dtype=np.uint64), 21)


def code_points(texts: list[str]):
    """All code points of the texts, one after the other, and where each text begins (one more at the end)."""
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), np.cumsum([0, *map(len, texts)])


def fold(texts: list[str]) -> list[str]:
    """Composed (NFC); characters whose lower case is longer are lowered here, the rest later by table."""
    out = []
    for t in texts:
        if not t.isascii():
            t = t if unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t)
            t = t.replace("İ", "İ".lower()) if "İ" in t else t
        out.append(t)
    return out


def _contractions(cp: np.ndarray, kind: np.ndarray, begin: np.ndarray, end_of: np.ndarray, joined: np.ndarray):
    """Where an apostrophe alone starts 's 't 'm 'd 're 've 'll, and how long that is."""
    n = len(cp)
    at = np.flatnonzero((cp == 39) & begin & ~joined)
    at = at[at + 1 < end_of[at]]
    at = at[kind[at + 1] == LETTER]
    a = cp[at + 1]
    b = np.where(at + 2 < end_of[at], cp[np.minimum(at + 2, n - 1)], 0)
    two = np.isin(a, [ord(x) for x in "stmd"])
    three = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
    size = np.where(two, 2, np.where(three, 3, 0))
    return at[size > 0], size[size > 0]


def _runs(cp: np.ndarray, offsets: np.ndarray):
    kind = classes()[cp]
    head = np.zeros(len(cp) + 1, bool)
    head[offsets[:-1]] = True
    head = head[:-1]
    begin = head.copy()
    begin[1:] |= kind[1:] != kind[:-1]
    begin[:1] = True
    ends = np.repeat(offsets[1:], np.diff(offsets))
    return kind, head, begin, ends


def split_joined(cp: np.ndarray, offsets: np.ndarray):
    """Start of each pretoken, where a single space goes with what follows and numbers run on. Every character belongs to one."""
    if not len(cp):
        return np.zeros(0, np.int64)
    kind, head, begin, ends = _runs(cp, offsets)
    joined = np.zeros(len(cp), bool)
    joined[1:] = (cp[:-1] == 32) & ~head[1:]
    start = begin & ((kind == SPACE) | ~joined)
    # the last space before something else stands alone or goes with it
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~head[1:])
    start[last] = True
    at, size = _contractions(cp, kind, begin, ends, joined)
    start[at + 1] = False
    start[at] = True
    after = at + size
    ok = after < ends[at]
    after = after[ok]
    start[after[kind[after] == LETTER]] = True
    return np.flatnonzero(start)


def split_apart(cp: np.ndarray, offsets: np.ndarray):
    """Start and end of each pretoken, where spaces are dropped and each number character stands alone."""
    if not len(cp):
        none = np.zeros(0, np.int64)
        return none, none
    kind, head, begin, ends = _runs(cp, offsets)
    start = begin | (kind == NUMBER)
    at, size = _contractions(cp, kind, begin, ends, np.zeros(len(cp), bool))
    start[at + 1] = False
    after = at + size
    after = after[after < ends[at]]
    start[after[kind[after] == LETTER]] = True
    starts = np.flatnonzero(start)
    stops = np.r_[starts[1:], len(cp)]
    keep = kind[starts] != SPACE
    return starts[keep], stops[keep]


def pretoken_hashes(cp: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    sums = words.prefix_sums(_mixed()[cp], words._P)
    h = words.mix(words.window_values(sums, starts, stops, words._P) ^ (stops - starts).astype(np.uint64), 4)
    return np.where(h == 0, np.uint64(1), h)


class Cache:
    """Remembers a number for each hash, in a table of fixed size where a newer entry takes an older one's place."""

    def __init__(self, bits: int = 20):
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.zeros(1 << bits, np.int64)

    def get(self, h: np.ndarray):
        slot = h & self.mask
        return self.values[slot], self.keys[slot] == h

    def put(self, h: np.ndarray, value: np.ndarray) -> None:
        slot = h & self.mask
        self.keys[slot] = h
        self.values[slot] = value


def cut_specials(texts: list[str], specials: tuple[str, ...]):
    """Texts without the special strings, as (parts, text of each part, special after the part or -1)."""
    pattern = re.compile("|".join(map(re.escape, specials)))
    parts, of, after = [], [], []
    for i, t in enumerate(texts):
        at = 0
        if "<|" in t:
            for m in pattern.finditer(t):
                parts.append(t[at : m.start()])
                of.append(i)
                after.append(specials.index(m[0]))
                at = m.end()
        parts.append(t[at:])
        of.append(i)
        after.append(-1)
    return parts, np.array(of), np.array(after)
