"""Words and hashes of words and of word windows, for many texts at once.

All hashes are polynomials over the integers modulo 2**64, taken from prefix
sums, so a text costs a few passes whatever the number of windows.
"""

from __future__ import annotations

import numpy as np

_P = 0x9E3779B97F4A7C15 | 1
_B = 0xC2B2AE3D27D4EB4F | 1
_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Scramble 64-bit values (splitmix64)."""
    with np.errstate(over="ignore"):
        h = h + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(256, dtype=np.uint64), 11)
#: The six bytes that divide words: space and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 16), np.uint64(base % 2**64))
        held[0] = 1
        held = np.cumprod(held)
        _powers[base] = held
    return held[:n]


def prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def window_values(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """The polynomial of values[start:end], wherever it stands."""
    inverse = pow(base, -1, 2**64)
    return (sums[end] - sums[start]) * powers(inverse, len(sums))[start]


def spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE):
    """Start and end of each word in `data`, and the first word of each text (one more at the end). gap: which bytes divide words."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~gap[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    heads = offsets[:-1][np.diff(offsets) > 0]
    start[heads] = inside[heads]
    tails = offsets[1:][np.diff(offsets) > 0] - 1
    end[tails] = inside[tails]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    sums = prefix_sums(_BYTE[data], _P)
    return mix(window_values(sums, starts, ends, _P) ^ (ends - starts).astype(np.uint64))


def windows(words: np.ndarray, first: np.ndarray, size: int):
    """Rabin-Karp hashes of every `size` consecutive words of one text, and the index of the word where each starts."""
    if len(words) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sums = prefix_sums(words, _B)
    at = np.arange(len(words) - size + 1)
    text = np.searchsorted(first, at, "right") - 1
    at = at[at + size <= first[text + 1]]
    return mix(window_values(sums, at, at + size, _B), 3), at
