"""Benchmark decontamination with spaced seeds.

Fixed masks pick some positions of a short window and ignore the others, so a
hash over the picked words still meets when an ignored word was replaced. Hits
between benchmark and corpus name an alignment; the words around the hit are
then compared one by one, and an overlap counts if a stretch of it has enough
equal words, replaced words and all.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import free_name, ship, slices, text_buffers
from .toxicity import _FOLD, _GAP

#: The masks, by the least number of words of the items that they are for. However the words that may be replaced lie
#: (4 of any 20; of shorter items, which are compared whole, one fifth), some mask of the item's size meets only words that are left.
MASKS = {8: ("10111", "1000001011"), 13: ("110111", "100000001111"), 20: ("1101111", "1100010111", "1110000000111")}
_EACH = [(least, mask) for least, masks in MASKS.items() for mask in masks]
#: Words compared, and the share of them that must be equal. Items with fewer words are compared whole; with fewer than LEAST they are ignored.
STRETCH, SHARE, LEAST = 20, 0.8, 8
#: Bytes of benchmark text that are sent to every task at a time; a larger benchmark is worked in blocks of that size.
BLOCK_BYTES = 8 << 20
_BITS = 22


def fold_words(data: np.ndarray, offsets: np.ndarray):
    """Hashes of the words of each text (letters and digits, ASCII case folded), and the first word of each text."""
    data = _FOLD[data]
    starts, ends, first = words.spans(data, offsets, _GAP)
    return words.hashes(data, starts, ends), first


def seeds(hashed: np.ndarray, first: np.ndarray, mask: str, seed: int):
    """Hash of the picked words for each window of one text, and where the window starts."""
    picked = [i for i, c in enumerate(mask) if c == "1"]
    n = len(hashed) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for i in picked:
        total = total * np.uint64(words._B) + hashed[i : i + n]
    at = np.arange(n)
    ends = np.repeat(first[1:], np.diff(first))[:n]
    at = at[at + len(mask) <= ends]
    return words.mix(total[at], 50 + seed), at


@dataclass
class Index:
    """Seeds of a block of benchmark items, ascending, with item and place of each; and the items' words."""

    items: list
    hashed: np.ndarray
    first: np.ndarray
    names: np.ndarray
    item: np.ndarray
    at: np.ndarray
    used: list

    def table(self) -> np.ndarray:
        out = np.zeros(1 << _BITS, bool)
        out[self.names & np.uint64((1 << _BITS) - 1)] = True
        return out


def index(items: list, texts: list[str]) -> Index:
    raw = [t.encode() for t in texts]
    hashed, first = fold_words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    sizes = np.diff(first)
    own = np.select([sizes >= least for least in sorted(MASKS, reverse=True)], sorted(MASKS, reverse=True), 0)
    found = []
    for i, (least, mask) in enumerate(_EACH):
        names, at = seeds(hashed, first, mask, i)
        use = own[np.searchsorted(first, at, "right") - 1] == least
        found.append((names[use], at[use]))
    used = [len(f[0]) > 0 for f in found]
    names, at = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    order = np.argsort(names, kind="stable")
    names, at = names[order], at[order]
    item = np.searchsorted(first, at, "right") - 1
    return Index(items, hashed, first, names, item, at - first[item], used)


def best_stretch(equal: np.ndarray, size: int):
    """Start and number of equal words of the best `size` words in a row; the first of equals."""
    total = np.r_[0, np.cumsum(equal)]
    got = total[size:] - total[:-size]
    at = int(got.argmax())
    return at, int(got[at])


def _search(batches, sent):
    x: Index = sent.value
    table = x.table()
    sizes = np.diff(x.first)
    for part in slices(batches, "text"):
        data, offsets = text_buffers(part.column("text"))
        hashed, first = fold_words(data, offsets)
        pairs = []
        for i, (_, m) in enumerate(_EACH):
            if not x.used[i]:
                continue
            h, at = seeds(hashed, first, m, i)
            keep = table[h & np.uint64((1 << _BITS) - 1)]
            h, at = h[keep], at[keep]
            a, b = np.searchsorted(x.names, h, "left"), np.searchsorted(x.names, h, "right")
            n = b - a
            which = np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            doc = np.searchsorted(first, np.repeat(at, n), "right") - 1
            pairs.append(np.stack([doc, x.item[which], np.repeat(at, n) - first[doc] - x.at[which]], 1))
        pairs = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 3), np.int64)
        ids = part.column("doc_id").to_pylist()
        best: dict = {}
        for doc, item, shift in pairs.tolist():
            d0, d1, i0, n = int(first[doc]), int(first[doc + 1]), int(x.first[item]), int(sizes[item])
            size = min(STRETCH, n)
            if n < LEAST:
                continue
            lo, hi = max(0, -shift), min(n, d1 - d0 - shift)
            if hi - lo < size:
                continue
            equal = hashed[d0 + shift + lo : d0 + shift + hi] == x.hashed[i0 + lo : i0 + hi]
            at, matched = best_stretch(equal, size)
            if matched >= SHARE * size:
                row = (int(equal.sum()), -(lo + at), -shift, size, matched)
                best[doc, item] = max(best.get((doc, item), row), row)
        rows = [(ids[doc], x.items[item], -r[2] - r[1], -r[1], r[3], r[4], r[0]) for (doc, item), r in sorted(best.items())]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(7)], ["doc_id", "item_id", "doc_start", "item_start", "stretch", "matched", "aligned_equal"])


def overlaps(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document and item that overlap: doc_id, item_id, doc_start and item_start (words before the best stretch), stretch (its words), matched (equal ones), aligned_equal (equal words of the whole alignment).

    Null and empty texts overlap nothing. Repeated rows are answered each;
    null ids are kept as null; other columns are ignored. The benchmark is worked in
    blocks of at most block_bytes of text (an item is never split), each sent
    to all tasks.
    """
    spark = docs.sparkSession
    ship(spark)
    schema = "doc_id long, item_id long, doc_start long, item_start long, stretch long, matched long, aligned_equal long"
    base = docs.select(F.col("doc_id").cast("long"), "text").where("text is not null")
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("length(text) > 0")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(size) // max(1, block_bytes // 2)))
    out = None
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        sent = spark.sparkContext.broadcast(index([r[0] for r in own], [r[1] for r in own]))
        found = base.mapInArrow(lambda it, sent=sent: _search(it, sent), schema)
        out = found if out is None else out.unionByName(found)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents that overlap an item; rows are judged by their text, whatever their ids."""
    mark = free_name(docs, "leak_mark")
    hit = overlaps(docs.select(F.xxhash64("text").alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias(mark)).distinct()
    return docs.join(hit, F.xxhash64("text") == F.col(mark), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
