"""Substring dedup: remove word windows that already stand in an earlier document.

Every window of `size` consecutive words gets a Rabin-Karp hash. A task sends
each distinct hash of a slice once, with the smallest document that has it,
packed by hash range; the reduce side finds the smallest document of all for
each hash and answers with the windows to remove. The answers meet again per
slice, become maximal intervals per document, and only then join the texts.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import fan_out, ship, slices, text_buffers

_NONE = np.iinfo(np.int64).max
_KEPT = 7  # bytes of the hash that travel; the group holds the other bits


def _pack(*arrays: np.ndarray) -> bytes:
    body = b"".join(a.tobytes() for a in arrays)
    return struct.pack("<i", len(arrays)) + b"".join(struct.pack("<q2s", a.size, a.dtype.str[1:].encode()) for a in arrays) + zstandard.ZstdCompressor(level=1).compress(body)


def _unpack(data: bytes) -> list[np.ndarray]:
    n = struct.unpack_from("<i", data)[0]
    heads = [struct.unpack_from("<q2s", data, 4 + 10 * i) for i in range(n)]
    body, at, out = zstandard.ZstdDecompressor().decompress(data[4 + 10 * n :]), 0, []
    for size, kind in heads:
        kind = np.dtype(f"<{kind.decode()}")
        out.append(np.frombuffer(body, kind, size, at))
        at += size * kind.itemsize
    return out


def _steps(values: np.ndarray) -> np.ndarray:
    """Differences of ascending numbers, in as few bytes as hold them."""
    d = np.diff(values, prepend=0)
    return d.astype(np.uint16 if not len(d) or d.max() < 1 << 16 else np.uint64)


def _sums(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps.astype(np.int64))


def _send(batches, size: int, groups: int):
    """Rows (key, slice, payload): key >= 0 holds hashes of one range; key < 0 holds what the slice itself knows."""
    for part in slices(batches, "text"):
        data, offsets = text_buffers(part.column("text"))
        ids = np.array([_NONE if x is None else x for x in part.column("doc_id").to_pylist()], np.int64)
        marks = np.array(part.column("mark").to_pylist(), np.int64)
        starts, ends, first = words.spans(data, offsets)
        hashed, at = words.windows(words.hashes(data, starts, ends), first, size)
        if not len(at):
            continue
        text = np.searchsorted(first, at, "right") - 1
        owner = ids[text]
        order = np.lexsort((at, owner, hashed))
        h, o, g = hashed[order], owner[order], at[order]
        head = np.r_[True, h[1:] != h[:-1]]
        group = np.cumsum(head) - 1
        lead = np.flatnonzero(head)
        later = o > o[lead][group]  # stands in a smaller document of this slice
        same = ~later & ~head  # again in the same document: follows what becomes of the first
        name = int(words.mix(np.array([hash((*ids.tolist(), *marks.tolist())) % 2**64], np.uint64), 5)[0] >> np.uint64(1))
        known = _pack(ids, marks, first.astype(np.int64), np.sort(g[later]), g[same], g[lead][group][same])
        rows = [(-1 - name % groups, name, known)]
        # one row for each range of hashes, in the order of the text inside
        h, g = h[lead], g[lead]
        key = (words.mix(h, 9) % np.uint64(groups)).astype(np.int64)
        order = np.lexsort((g, key))
        h, g, key = h[order], g[order], key[order]
        bounds = np.r_[0, np.flatnonzero(np.diff(key)) + 1, len(key)]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            t = np.searchsorted(first, g[a:b], "right") - 1
            docs, runs = np.unique(t, return_counts=True)
            body = h[a:b].view(np.uint8).reshape(-1, 8)[:, :_KEPT].tobytes()
            rows.append((int(key[a]), name, struct.pack("<q", b - a) + body + _pack(_steps(g[a:b]), ids[docs], runs.astype(np.uint32))))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], ["key", "slice", "payload"])


def _judge(pdf: pd.DataFrame) -> pd.DataFrame:
    """For the hashes of one range: the windows of each slice that start in a smaller document too."""
    if pdf["key"].iloc[0] < 0:
        return pdf[["slice", "payload"]].assign(known=True)
    hs, gs, ds, of = [], [], [], []
    for i, data in enumerate(pdf["payload"]):
        n = struct.unpack_from("<q", data)[0]
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :_KEPT] = np.frombuffer(data, np.uint8, n * _KEPT, 8).reshape(n, _KEPT)
        steps, ids, runs = _unpack(data[8 + n * _KEPT :])
        hs.append(wide.view("<u8").ravel())
        gs.append(_sums(steps).astype(np.uint32))
        ds.append(np.repeat(ids, runs))
        of.append(np.full(n, i, np.int32))
    h, g, d, of = map(np.concatenate, (hs, gs, ds, of))
    order = np.argsort(h)
    h = h[order]
    head = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    least = np.repeat(np.minimum.reduceat(d[order], head), np.diff(np.r_[head, len(h)]))
    hit = order[d[order] > least]
    hit.sort()
    of, g = of[hit], g[hit]
    bounds = np.r_[0, np.flatnonzero(np.diff(of)) + 1, len(of)] if len(of) else np.zeros(1, int)
    names = pdf["slice"].to_numpy()
    rows = [(names[of[a]], _pack(_steps(g[a:b].astype(np.int64))), False) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return pd.DataFrame(rows, columns=["slice", "payload", "known"])


def _settle(pdf: pd.DataFrame, size: int) -> pd.DataFrame:
    """Of one slice: the maximal intervals of words to remove, for each document."""
    ids, marks, first, local, other, lead = _unpack(pdf.loc[pdf["known"], "payload"].iloc[0])
    found = [_sums(_unpack(x)[0]) for x in pdf.loc[~pdf["known"], "payload"]]
    hit = np.zeros(first[-1] + 1, bool)
    for x in (*found, local):
        hit[x] = True
    hit[other[hit[lead]]] = True
    at = np.flatnonzero(hit)
    if not len(at):
        return pd.DataFrame({"doc_id": pd.Series(dtype="Int64"), "mark": pd.Series(dtype="int64"), "cuts": pd.Series(dtype=object)})
    text = np.searchsorted(first, at, "right") - 1
    new = np.r_[True, (at[1:] > at[:-1] + size) | (text[1:] != text[:-1])]
    begin, last = at[new], at[np.r_[new[1:], True]] + size
    text = text[new]
    rows = []
    for t in np.unique(text):
        mine = text == t
        cuts = np.stack([begin[mine] - first[t], last[mine] - first[t]], 1)
        rows.append((None if ids[t] == _NONE else ids[t], marks[t], cuts.ravel().tolist()))
    out = pd.DataFrame(rows, columns=["doc_id", "mark", "cuts"])
    return out.assign(doc_id=out["doc_id"].astype("Int64"))


def _apply(batches, text_out: bool):
    for part in slices(batches, "text"):
        data, offsets = text_buffers(part.column("text"))
        starts, ends, first = words.spans(data, offsets)
        cuts = part.column("cuts").to_pylist()
        whole = data.tobytes()
        n, gone, digest, kept_text = [], [], [], []
        for i, c in enumerate(cuts):
            a, b = int(first[i]), int(first[i + 1])
            keep = np.ones(b - a, bool)
            for x, y in zip((c or [])[::2], (c or [])[1::2], strict=True):
                keep[x:y] = False
            own = np.flatnonzero(keep) + a
            kept = b" ".join([whole[s:e] for s, e in zip(starts[own].tolist(), ends[own].tolist(), strict=True)])
            n.append(b - a)
            gone.append(b - a - len(own))
            digest.append(hashlib.sha256(kept).hexdigest())
            kept_text.append(kept.decode() if text_out else None)
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "cuts"] + ["kept_text"] * text_out
        arrays = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string()), pa.array([x or [] for x in cuts], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays + [pa.array(kept_text, pa.string())] * text_out, names)


def repeated_spans(docs: DataFrame, size: int = 13) -> DataFrame:
    """Per document with something to remove: (doc_id, mark, cuts), cuts being begin and end of each maximal removal interval, in words.

    `mark` is the hash of the text; with doc_id it names the row, so rows that
    repeat a doc_id with other text stay apart. Windows are judged on the input.
    Null text has no words; a null doc_id counts as larger than all others.
    Texts under `size` words have no window. Other columns are ignored.
    """
    ship(docs.sparkSession)
    groups = fan_out(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("mark"))
    sent = base.mapInArrow(lambda it: _send(it, size, groups), "key long, slice long, payload binary")
    judged = sent.groupBy("key").applyInPandas(_judge, "slice long, payload binary, known boolean")
    return judged.groupBy("slice").applyInPandas(lambda pdf: _settle(pdf, size), "doc_id long, mark long, cuts array<long>")


def substring_dedup(docs: DataFrame, size: int = 13, text_out: bool = True) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, cuts (begin and end of removed intervals, in words) and, if text_out, kept_text.

    A word goes if a window of `size` words that covers it also starts in a
    document with a smaller doc_id. An empty table gives an empty result;
    null text counts as no words (kept_text is empty); rows that repeat both
    doc_id and text are each returned, judged alike.
    """
    base = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("mark"))
    cuts = repeated_spans(docs, size).groupBy("doc_id", "mark").agg(F.first("cuts").alias("cuts")).select(F.col("doc_id").alias("c_id"), F.col("mark").alias("c_mark"), "cuts")
    joined = base.join(cuts, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("mark") == F.col("c_mark")), "left").select("doc_id", "text", "cuts")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, cuts array<long>" + ", kept_text string" * text_out
    return joined.mapInArrow(lambda it: _apply(it, text_out), schema)
