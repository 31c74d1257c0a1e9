"""Token counts by a transducer compiled from a BPE tokenizer with word ends.

Merges are compiled into a deterministic machine: after each symbol of a word,
the state is the last token of the encoding so far (with those of the symbols
just before), and the transition carries the number of tokens it adds to the
count. The next state follows from two compiled tables: which token ends here
with which length, and which token may follow which. Long words are cut into
chunks; each chunk's map from entry state to exit state and count is worked out
beside the others, from a warm-up before the chunk, and the maps are composed in
order. Counts of texts are differences of prefix sums over all pretokens.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pretokens as pre
from . import words
from .common import ship, slices

#: Words with more symbols are worked in chunks of this size, each with this warm-up.
CHUNK, WARM_UP = 256, 64


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Transducer:
    """Counts of tokens of whole pretokens; symbols are bytes, plus 256 if the word ends there."""

    def __init__(self, path: str):
        held = json.load(open(path, encoding="utf-8"))
        model = held["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.specials = tuple(t["content"] for t in held["added_tokens"])
        back = {c: b for b, c in enumerate(byte_symbols())}
        vocab = model["vocab"]

        def symbols(token: str) -> tuple[int, ...]:
            ends = bool(self.suffix) and token.endswith(self.suffix)
            core = token[: -len(self.suffix)] if ends else token
            out = [back[c] for c in core]
            if ends and out:
                out[-1] += 256
            return tuple(out)

        # number the tokens by rank of their merge: single symbols first
        self.number: dict[str, int] = {}
        spelled: list[tuple[int, ...]] = []
        for b, c in enumerate(byte_symbols()):
            for plus, text in ((0, c), (256, c + self.suffix)):
                if text in vocab and text not in self.number and (plus == 0 or self.suffix):
                    self.number[text] = len(spelled)
                    spelled.append((b + plus,))
        self.single = len(spelled)
        self.parts = [(i, i) for i in range(self.single)]
        self.merged: dict[tuple[int, int], int] = {}
        for merge in model["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b = self.number[left], self.number[right]
            if left + right not in self.number:
                self.number[left + right] = len(spelled)
                spelled.append(symbols(left + right))
                self.parts.append((a, b))
            self.merged[a, b] = self.number[left + right]
        self.longest = max(map(len, spelled))
        self._suffixes(spelled)
        self.follows = pre.Cache(20)

    def _suffixes(self, spelled: list[tuple[int, ...]]) -> None:
        """Hashes of all suffixes of all tokens, ascending, with the token that each is, or -1."""
        flat = np.array([s for t in spelled for s in t], np.int64)
        ends = np.cumsum([len(t) for t in spelled])
        sums = words.prefix_sums(self._value(flat), words._P)
        names, ids = [], []
        sizes = np.array([len(t) for t in spelled])
        for size in range(1, self.longest + 1):
            use = np.flatnonzero(sizes >= size)
            names.append(self._hash(sums, ends[use] - size, ends[use]))
            ids.append(np.where(sizes[use] == size, use, -1))
        names, ids = np.concatenate(names), np.concatenate(ids)
        order = np.lexsort((-ids, names))
        names, ids = names[order], ids[order]
        first = np.r_[True, names[1:] != names[:-1]]
        self.names, self.ids = names[first], ids[first]

    @staticmethod
    def _value(symbols: np.ndarray) -> np.ndarray:
        return words.mix(symbols.astype(np.uint64), 31)

    @staticmethod
    def _hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return words.mix(words.window_values(sums, start, end, words._P) ^ (end - start).astype(np.uint64), 32)

    def _may_follow(self, a: int, b: int) -> bool:
        """Whether the encoding of token a's and b's spelling is a, b: no merge across the border comes before those that build a and b."""
        limit = len(self.parts)
        while True:
            over = self.merged.get((a, b))
            if over is not None and over < limit:
                return False
            # undo the later of the two merges; a single symbol has none
            can_a, can_b = a >= self.single, b >= self.single
            if can_a and (a > b or not can_b):
                limit, a = a, self.parts[a][1]
            elif can_b:
                limit, b = b + 1, self.parts[b][0]
            else:
                return True

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = words.mix(a.astype(np.uint64) << np.uint64(24) | b.astype(np.uint64), 33)
        value, known = self.follows.get(key)
        if not known.all():
            new, at = np.unique(key[~known], return_index=True)
            x, y = a[~known][at], b[~known][at]
            self.follows.put(new, np.array([self._may_follow(int(i), int(j)) for i, j in zip(x, y, strict=True)], np.int64))
            back = np.searchsorted(new, key[~known])
            value = value.copy()
            # entries of this call may take each other's place, so they are read from here
            value[~known] = np.array([self._may_follow(int(i), int(j)) for i, j in zip(x, y, strict=True)], np.int64)[back]
        return value.astype(bool)

    def _candidates(self, flat: np.ndarray, room: np.ndarray) -> np.ndarray:
        """For each position and length, the token that ends there, or -1. room: symbols of the same row up to and with the position."""
        out = np.full((len(flat), self.longest + 1), -1, np.int32)
        sums = words.prefix_sums(self._value(flat), words._P)
        live = np.arange(len(flat))
        for size in range(1, self.longest + 1):
            live = live[room[live] >= size]
            if not len(live):
                break
            h = self._hash(sums, live + 1 - size, live + 1)
            at = np.minimum(np.searchsorted(self.names, h), len(self.names) - 1)
            ok = self.names[at] == h
            live = live[ok]
            out[live, size] = self.ids[at[ok]]
        return out

    def _walk(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, entry: np.ndarray | None = None):
        """Run the machine over rows flat[start:start+size]. entry: last tokens of the symbols before each row (-2: none), newest last.

        Returns for each position the last token, and the tokens since the row's
        start (a token from before it counts where it ends).
        """
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        width = self.longest
        ahead = 0 if entry is None else entry.shape[1]
        top = int(sizes[0]) if len(sizes) else 0
        last = np.full((len(starts), ahead + top), -2, np.int32)
        count = np.zeros((len(starts), ahead + top), np.int32)
        if ahead:
            last[:, :ahead] = entry[order]
        pos = np.repeat(starts, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        room = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
        if ahead:
            room = np.minimum(room + ahead, pos + 1)
        cand = self._candidates(flat, np.bincount(pos, room, len(flat)).astype(np.int64)) if len(pos) else np.zeros((0, width + 1), np.int32)
        alive = len(sizes)
        for col in range(top):
            while alive and sizes[alive - 1] <= col:
                alive -= 1
            rows = np.arange(alive)
            mine = cand[starts[:alive] + col]
            for size in range(min(width, col + 1 + ahead), 0, -1):
                token = mine[rows, size]
                hit = token >= 0
                if not hit.any():
                    continue
                r, t = rows[hit], token[hit]
                at = col + ahead - size
                if at < 0:
                    before, n, good = None, np.zeros(len(r), np.int32), np.ones(len(r), bool)
                else:
                    before, n = last[r, at], count[r, at]
                    good = before == -2
                    check = ~good
                    if check.any():
                        good[check] = self.may_follow(before[check], t[check])
                    if ahead:  # a row that begins inside a word has no empty prefix to start from
                        good &= (before != -2) | (at >= ahead)
                r, t, n = r[good], t[good], n[good]
                last[r, ahead + col], count[r, ahead + col] = t, n + 1
                done = np.zeros(alive, bool)
                done[r] = True
                rows = rows[~done[rows]]
                if not len(rows):
                    break
        back = np.argsort(order, kind="stable")
        return last[back], count[back]

    def _long(self, flat: np.ndarray) -> int:
        """Tokens of one long word: chunks worked side by side, their state maps composed in order."""
        n, width = len(flat), self.longest
        begin = np.arange(0, n, CHUNK)
        warm = np.maximum(begin - WARM_UP, 0)
        stop = np.minimum(begin + CHUNK, n)
        last, count = self._walk(flat, warm, stop - warm)
        total, true = 0, None
        for i, (b, w, s) in enumerate(zip(begin, warm, stop, strict=True)):
            row, c = last[i, : s - w], count[i, : s - w]
            skip = b - w
            if true is not None and not (skip >= width and np.array_equal(row[skip - width : skip], true[0][-width:]) and np.array_equal(c[skip - width : skip] - c[skip - 1], true[1][-width:] - true[1][-1])):
                # the warm-up did not meet the true state: run the chunk from the last state that is sure
                entry_last, entry_count = true[0][-width:], true[1][-width:] - true[1][-1]
                row, c = self._resume(flat, b, s, entry_last, entry_count)
                skip = 0
                delta = int(c[-1])
            else:
                delta = int(c[-1]) - (int(c[skip - 1]) if skip else 0)
            total += delta
            own_last, own_count = row[max(0, len(row) - width) :], c[max(0, len(c) - width) :]
            true = (own_last, own_count)
        return total

    def _resume(self, flat, b, s, entry_last, entry_count):
        """Symbol by symbol from a known state."""
        last, count = list(entry_last), list(entry_count)
        lo = b - len(last)
        cand = self._candidates(flat[lo:s], np.arange(1, s - lo + 1))
        for p in range(b, s):
            for size in range(self.longest, 0, -1):
                token = int(cand[p - lo, size]) if size <= p - lo + 1 else -1
                if token < 0:
                    continue
                at = p - size - lo
                if at < 0 and p - size >= 0:
                    continue
                if at < 0 or self.may_follow(np.array([last[at]]), np.array([token]))[0]:
                    last.append(token)
                    count.append((count[at] if at >= 0 else 0) + 1)
                    break
        k = len(entry_last)
        return np.array(last[k:], np.int32), np.array(count[k:], np.int64)

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each pretoken, given as a string."""
        raw = [t.encode() for t in texts]
        flat = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
        sizes = np.array([len(r) for r in raw], np.int64)
        stops = np.cumsum(sizes)
        if self.suffix:
            flat[stops[sizes > 0] - 1] += 256
        out = np.zeros(len(raw), np.int64)
        short = np.flatnonzero((sizes > 0) & (sizes <= CHUNK))
        # a few thousand symbols at a time keep the tables small
        group = np.cumsum(sizes[short]) // 100_000
        for g in np.unique(group):
            use = short[group == g]
            a, b = int(stops[use[0]] - sizes[use[0]]), int(stops[use[-1]])
            _, count = self._walk(flat[a:b], stops[use] - sizes[use] - a, sizes[use])
            out[use] = count[np.arange(len(use)), sizes[use] - 1]
        for i in np.flatnonzero(sizes > CHUNK):
            out[i] = self._long(flat[stops[i] - sizes[i] : stops[i]])
        return out


@lru_cache(2)
def compiled(path: str) -> tuple[Transducer, pre.Cache]:
    return Transducer(path), pre.Cache(20)


def count_texts(texts: list[str], path: str) -> np.ndarray:
    """Tokens of each text, as the library counts them without added tokens."""
    machine, cache = compiled(path)
    parts, of, after = pre.cut_specials(texts, machine.specials)
    cp, offsets = pre.code_points(pre.fold(parts))
    cp = pre.lower()[cp]
    starts, stops = pre.split_apart(cp, offsets)
    h = pre.pretoken_hashes(cp, starts, stops)
    n, known = cache.get(h)
    if not known.all():
        new, at = np.unique(h[~known], return_index=True)
        s, e = starts[~known][at], stops[~known][at]
        spelled = cp.astype("<u4").tobytes()
        got = machine.counts([spelled[4 * a : 4 * b].decode("utf-32-le", "surrogatepass") for a, b in zip(s.tolist(), e.tolist(), strict=True)])
        n = n.copy()
        n[~known] = got[np.searchsorted(new, h[~known])]
        cache.put(new, got)
    total = np.r_[0, np.cumsum(n)]
    first = np.searchsorted(starts, offsets)
    each = total[first[1:]] - total[first[:-1]] + (after >= 0)
    return np.bincount(of, each, len(texts)).astype(np.int64)


def _count(batches, path: str, limit: int):
    for part in slices(batches, "text"):
        texts = [t or "" for t in part.column("text").to_pylist()]
        n = count_texts(texts, path)
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit, pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])


def count_tokens(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """Per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit. path: tokenizer file.

    Null text counts as empty (0 bytes, 0 tokens). Every row is answered; other
    columns are ignored; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lambda it: _count(it, path, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
