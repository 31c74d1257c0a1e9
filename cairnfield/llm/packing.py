"""Best-fit packing of tokenized documents into sequences of a fixed capacity.

Documents are cut into pieces and range-sorted by length, so pieces of equal
length lie together; the piece's place among its equals is its rank. Gaps are
sorted the same way. Each round takes the longest length that is left: all its
pieces sweep to the successor gap (the smallest that holds them), pieces that
want the same gap share it out by rank, the gaps shrink, and the next round
follows. What finds no gap opens sequences. Pieces of one length, and gaps of
one size, differ by nothing but rank, so a round works on the counts of both
(at most `capacity` of each, however many documents there are) and the tasks
then look up each piece's place by its rank.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pretokens as pre
from .common import cut, ship, slices

#: Ids that a worker remembers for pretokens it has met.
REMEMBERED = 4_000_000


class Encoder:
    """Ids of whole texts: each distinct pretoken is encoded once by the library."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.cache = pre.Cache(20)
        self.ids = np.zeros(REMEMBERED // 4, np.uint32)
        self.begin, self.size, self.used, self.words = np.zeros(1 << 18, np.int64), np.zeros(1 << 18, np.int32), 0, 0

    def _learn(self, texts: list[str]) -> np.ndarray:
        got = [e.ids for e in self.library.encode_batch(texts, add_special_tokens=False)]
        sizes = np.array([len(g) for g in got], np.int64)
        flat = np.array([i for g in got for i in g], np.uint32)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.r_[self.ids, np.zeros_like(self.ids)]
        while self.words + len(got) > len(self.begin):
            self.begin, self.size = np.r_[self.begin, np.zeros_like(self.begin)], np.r_[self.size, np.zeros_like(self.size)]
        at = np.arange(self.words, self.words + len(got))
        self.begin[at] = self.used + np.cumsum(sizes) - sizes
        self.size[at] = sizes
        self.ids[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        self.words += len(got)
        return at

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.used > REMEMBERED:
            self.forget()
        cp, offsets = pre.code_points(texts)
        starts = pre.split_joined(cp, offsets)
        stops = np.r_[starts[1:], len(cp)].astype(np.int64) if len(starts) else starts
        h = pre.pretoken_hashes(cp, starts, stops)
        word, known = self.cache.get(h)
        if not known.all():
            new, at = np.unique(h[~known], return_index=True)
            s, e = starts[~known][at], stops[~known][at]
            spelled = cp.tobytes()
            got = self._learn([spelled[4 * a : 4 * b].decode("utf-32-le", "surrogatepass") for a, b in zip(s.tolist(), e.tolist(), strict=True)])
            word = word.copy()
            word[~known] = got[np.searchsorted(new, h[~known])]
            self.cache.put(new, got)
        size = self.size[word].astype(np.int64)
        total = np.r_[0, np.cumsum(size)]
        flat = self.ids[np.repeat(self.begin[word] - total[:-1], size) + np.arange(total[-1])]
        bounds = total[np.searchsorted(starts, offsets)]
        out = [flat[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        for i, t in enumerate(texts):
            if any(x in t for x in self.specials):
                out[i] = np.array(self.library.encode(t, add_special_tokens=False).ids, np.uint32)
        return out


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _pieces(batches, path: str, capacity: int, last_id: int):
    e = encoder(path)
    for part in slices(batches, "text"):
        doc, piece, start, length, crc = [], [], [], [], []
        for name, ids in zip(part.column("doc_id").to_pylist(), e.encode([t or "" for t in part.column("text").to_pylist()]), strict=True):
            ids = np.append(ids, np.uint32(last_id)).astype("<u4")
            bounds = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
            for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                doc.append(name)
                piece.append(k)
                start.append(a)
                length.append(b - a)
                crc.append(zlib.crc32(ids[a:b].tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])


def pieces(docs: DataFrame, path: str, capacity: int = 2048, last_id: int = 0) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32): each document's ids and last_id, cut into pieces of `capacity` if longer, the first taking what is over."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda it: _pieces(it, path, capacity, last_id), "doc_id long, piece int, start long, length long, ids_crc32 long")


def _rank(batches):
    """The place of each row among those of its length in this partition."""
    seen: dict[int, int] = {}
    for batch in batches:
        length = batch.column("length").to_numpy()
        rank = np.zeros(len(length), np.int64)
        for n in np.unique(length):
            own = length == n
            rank[own] = seen.get(int(n), 0) + np.arange(own.sum())
            seen[int(n)] = seen.get(int(n), 0) + int(own.sum())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rank, pa.int64())], [*batch.schema.names, "rank"])


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rounds of best fit over classes. Rows (length, first rank, number, first sequence, offset): that many pieces go to as many sequences in a row."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences (first, number)
    sizes = np.zeros(capacity + 1, bool)
    plan, opened = [], 0

    def put(gap: int, first: int, n: int) -> None:
        if n and gap:
            gaps.setdefault(gap, []).append((first, n))
            sizes[gap] = True

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0

        def fill(first: int, n: int, gap: int, length: int = length) -> None:
            """Pieces of this length into n sequences with this gap each, as many as go in."""
            nonlocal left, rank
            deep = gap // length
            whole = min(n, left // deep)
            for first, n, slots in ((first, whole, deep), (first + whole, min(1, n - whole), left - whole * deep)):  # noqa: B020
                slots = min(slots, deep)
                if not n or not slots:
                    continue
                for k in range(slots):
                    plan.append((length, rank, n, first, capacity - gap + k * length))
                    rank += n
                    left -= n
                put(gap - slots * length, first, n)

        while left:
            fits = np.flatnonzero(sizes[length:])
            if not len(fits):
                n = -(-left // (capacity // length))
                opened += n
                fill(opened - n, n, capacity)
                continue
            gap = length + int(fits[0])
            runs = gaps[gap]
            first, n = runs.pop()
            use = min(n, -(-left // (gap // length)))
            if n > use:
                runs.append((first + use, n - use))
            if not runs:
                sizes[gap] = False
            fill(first, use, gap)
    return plan


def _place(batches, sent):
    keys, lengths, firsts, sequences, offsets, bases = sent.value
    for batch in batches:
        length = batch.column("length").to_numpy()
        rank = batch.column("rank").to_numpy() + bases[1][np.searchsorted(bases[0], batch.column("part").to_numpy().astype(np.int64) << 32 | length)]
        at = np.searchsorted(keys, (length.astype(np.int64) << 40) | rank, "right") - 1
        drop = ("part", "rank")
        names = [n for n in batch.schema.names if n not in drop]
        yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(sequences[at] + rank - firsts[at], pa.int64()), pa.array(offsets[at], pa.int64())], [*names, "sequence_id", "offset"])


def pack(docs: DataFrame, path: str, capacity: int = 2048, last_id: int = 0) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are documents of last_id alone. Repeated rows are
    packed each; an empty table gives an empty result; other columns are
    ignored. Ties of length are placed by doc_id, then piece.
    """
    spark = docs.sparkSession
    # range partitioning samples its input first, so the pieces are made before
    made = cut(pieces(docs, path, capacity, last_id))
    sorted_ = made.repartitionByRange("length", "doc_id", "piece").sortWithinPartitions("length", "doc_id", "piece")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    ranked = cut(sorted_.mapInArrow(_rank, schema + ", rank long").withColumn("part", F.spark_partition_id()))
    # one row for each partition and length in it: lengths lie together, so about the number of partitions plus `capacity`
    found = sorted((r["part"], r["length"], r["n"]) for r in ranked.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")).collect())
    counts: dict[int, int] = {}
    base = []
    for _, length, n in found:
        base.append(counts.get(length, 0))
        counts[length] = base[-1] + n
    plan = sorted(best_fit(counts, capacity))
    columns = [np.array([p[i] for p in plan], np.int64) for i in range(5)]
    held = (columns[0] << 40 | columns[1], columns[0], columns[1], columns[3], columns[4], (np.array([p << 32 | n for p, n, _ in found], np.int64), np.array(base, np.int64)))
    sent = spark.sparkContext.broadcast(held)
    return ranked.mapInArrow(lambda it: _place(it, sent), schema + ", sequence_id long, offset long")
