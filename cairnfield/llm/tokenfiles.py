"""Token ids in files of 64-bit words: Simple-8b with escapes.

A word holds a selector in its top four bits and as many ids as the selector
says, all of one width. An id that is too wide for the word that it falls in
is written there as all ones, and in full (32 bits) behind the words of its
block. A block has at most BLOCK ids and begins on a word, so blocks are coded
and decoded apart; a segment holds whole documents, their names and lengths,
the place of its first id among all ids, and where each block begins. A file is
a row of segments, each closed by a mark of one word.

Documents are range-partitioned by doc_id and encoded once, where they lie. Places follow
from one total for each range. Spark's writer makes the files, so the task of
a lost executor is run again and leaves nothing behind.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ship, slices
from .packing import encoder

# Fixed values of the format: ids in a word and bits of each, by selector.
COUNTS = (240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
MAGIC, MARK = b"S8BIDS01", "\nS8BEND\n"
HEAD = struct.Struct("<8sqqQQQ")
#: Ids of a block; ids after which a segment is closed (a longer document is one segment); segments of a file.
BLOCK, SEGMENT, SEGMENTS = 1024, 1 << 20, 32
NAMELESS = np.uint64(1) << np.uint64(63)

_COUNTS = np.array(COUNTS, np.int64)
_ESCAPED = [(1 << b) - 1 if 0 < b < 60 else None for b in BITS]


def _choose(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins, and its selector: that which costs fewest bits an id, escapes counted. All blocks take a step at a time together."""
    rows = -(-len(ids) // BLOCK)
    table = np.zeros((rows, BLOCK), np.uint32)
    table.ravel()[: len(ids)] = ids
    # what a word costs at most that holds any id
    bar = 64 / max(c for c, e in zip(COUNTS, _ESCAPED, strict=True) if c == 1 or e is not None and int(ids.max()) < e)
    used, sums = [], []
    # of equal costs the wider word is taken: it holds fewer escapes
    for s in range(15, -1, -1):
        c, over = COUNTS[s], np.zeros((rows, BLOCK + 1), np.int32)
        if BITS[s] < 60:
            wide = table >= (_ESCAPED[s] or 1)
            # escapes that a word may hold and still be worth it; any c ids in a row lie in two neighbours of the runs of c
            room = (bar * c - 64) / 32 if BITS[s] else 0
            np.cumsum(wide, axis=1, dtype=np.int32, out=over[:, 1:])
            # left out: what could help in one run of fifty at most, as each selector costs a step for every word
            marks = over[:, ::c]
            fit = c - np.diff(marks, axis=1).ravel()
            if s < 13 and np.count_nonzero(fit + np.r_[fit[1:], fit[:1]] >= c - room) * 50 < len(fit):
                continue
        used.append(s)
        sums.append(over)
    used = np.array(used)
    flat, count = np.concatenate(sums).ravel(), _COUNTS[used][:, None].astype(np.int32)
    price = np.array([32 if BITS[s] else 1e9 for s in used], np.float32)[:, None]
    row, pos = np.arange(rows), np.zeros(rows, np.int32)
    held = np.minimum(BLOCK, len(ids) - BLOCK * row).astype(np.int32)
    line = (np.arange(len(used))[:, None] * rows + row) * (BLOCK + 1)
    first, chosen = [], []
    while len(row):
        here = line + pos
        take = np.minimum(count, held - pos)
        cost = flat.take(here + take) - flat.take(here)
        pick = ((cost * price + np.float32(64)) / take).argmin(0)
        first.append(row * BLOCK + pos)
        chosen.append(used[pick])
        pos = pos + take[pick, np.arange(len(row))]
        on = pos < held
        if not on.all():
            row, pos, held, line = row[on], pos[on], held[on], line[:, on]
    first, chosen = np.concatenate(first), np.concatenate(chosen)
    order = np.argsort(first)
    return first[order], chosen[order]


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of all blocks, and for each block where its words and its escapes begin (one more at the end)."""
    n = len(ids)
    if not n:
        return np.zeros(1, np.uint32), np.zeros(0, np.uint64)
    first, chosen = _choose(ids)
    left = np.minimum(BLOCK - first % BLOCK, n - first)
    words = chosen.astype(np.uint64) << np.uint64(60)
    padded = np.r_[ids, np.zeros(COUNTS[0], ids.dtype)].astype(np.uint64)
    escaped = []
    for s in np.unique(chosen).tolist():
        if not BITS[s]:
            continue
        own = np.flatnonzero(chosen == s)
        slot = np.arange(COUNTS[s])
        place = first[own][:, None] + slot
        field = np.where(slot < left[own][:, None], padded[place], np.uint64(0))
        if _ESCAPED[s] is not None:
            out = field >= np.uint64(_ESCAPED[s])
            field[out] = _ESCAPED[s]
            escaped.append(place[out])
        words[own] |= np.bitwise_or.reduce(field << (slot * BITS[s]).astype(np.uint64), axis=1)
    blocks = -(-n // BLOCK)
    out = np.sort(np.concatenate(escaped)) if escaped else np.zeros(0, np.int64)
    coded, over = np.bincount(first // BLOCK, minlength=blocks), np.bincount(out // BLOCK, minlength=blocks)
    sizes = np.stack([coded, -(-over // 2)], 1).ravel()
    offsets = np.r_[0, np.cumsum(sizes)]
    data = np.zeros(offsets[-1], np.uint64)
    data[np.repeat(offsets[:-1:2] - (np.cumsum(coded) - coded), coded) + np.arange(len(words))] = words
    data.view(np.uint32)[np.repeat(2 * offsets[1::2] - (np.cumsum(over) - over), over) + np.arange(len(out))] = ids[out]
    return offsets.astype(np.uint32), data


def decode_blocks(data: np.ndarray, offsets: np.ndarray, n: int, begin: int = 0, end: int | None = None) -> np.ndarray:
    """Ids of the blocks from `begin` to `end`; n: ids of all blocks."""
    blocks = len(offsets) // 2
    end = blocks if end is None else end
    if begin >= end:
        return np.zeros(0, np.uint32)
    offsets = offsets.astype(np.int64)
    codes, over, stop = offsets[2 * begin : 2 * end : 2], offsets[2 * begin + 1 : 2 * end : 2], offsets[2 * begin + 2 : 2 * end + 2 : 2]
    coded = over - codes
    last = np.cumsum(coded) - 1
    words = data[np.repeat(codes - (last + 1 - coded), coded) + np.arange(coded.sum())]
    chosen = (words >> np.uint64(60)).astype(np.int64)
    count = _COUNTS[chosen]
    held = np.full(end - begin, BLOCK)
    if end == blocks:
        held[-1] = n - BLOCK * (blocks - 1)
    # the last word of a block may hold fewer
    count[last] -= np.add.reduceat(count, last + 1 - coded) - held
    place = np.cumsum(count) - count
    out = np.zeros(int(held.sum()), np.uint64)
    escaped = []
    for s in np.unique(chosen).tolist():
        if not BITS[s]:
            continue
        own = np.flatnonzero(chosen == s)
        slot = np.arange(COUNTS[s])
        field = words[own][:, None] >> (slot * BITS[s]).astype(np.uint64) & np.uint64((1 << BITS[s]) - 1)
        real = slot < count[own][:, None]
        spots = (place[own][:, None] + slot)[real]
        field = field[real]
        out[spots] = field
        if _ESCAPED[s] is not None:
            escaped.append(spots[field == np.uint64(_ESCAPED[s])])
    spots = np.sort(np.concatenate(escaped)) if escaped else np.zeros(0, np.int64)
    n_over = np.bincount(np.searchsorted(np.cumsum(held), spots, "right"), minlength=end - begin)
    if (-(-n_over // 2) != stop - over).any():
        raise ValueError("a block's escapes are not as many as its words say")
    out[spots] = data.view(np.uint32)[np.repeat(2 * over - (np.cumsum(n_over) - n_over), n_over) + np.arange(len(spots))]
    return out.astype(np.uint32)


def segment(names: list, lengths: list[int], ids: np.ndarray, place: int, part: int = 0) -> bytes:
    """The bytes of one segment: documents `names` (null: nameless) of `lengths`, whose ids follow each other from `place` of range `part` on."""
    offsets, data = encode_blocks(ids)
    sizes = np.array(lengths, np.uint64) | np.where([x is None for x in names], NAMELESS, np.uint64(0))
    index = np.r_[offsets, np.zeros(len(offsets) % 2, np.uint32)]
    return HEAD.pack(MAGIC, part, place, len(names), len(ids), len(data)) + np.array([x or 0 for x in names], "<i8").tobytes() + sizes.astype("<u8").tobytes() + index.astype("<u4").tobytes() + data.astype("<u8").tobytes()


def segments_of(content: bytes):
    """Segments of a file: (range, place of the first id in it, names, lengths, number of ids, block offsets, words)."""
    at, mark = 0, MARK.encode()
    while at < len(content):
        magic, part, place, n_docs, n_ids, n_words = HEAD.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError("not a segment of token ids")
        at += HEAD.size
        names = np.frombuffer(content, "<i8", n_docs, at)
        sizes = np.frombuffer(content, "<u8", n_docs, at + 8 * n_docs)
        at += 16 * n_docs
        n_offsets = 2 * -(-n_ids // BLOCK) + 1
        offsets = np.frombuffer(content, "<u4", n_offsets, at)
        at += 4 * (n_offsets + n_offsets % 2)
        words = np.frombuffer(content, "<u8", n_words, at)
        at += 8 * n_words
        if content[at : at + len(mark)] != mark:
            raise ValueError("a segment's length is not what its head says")
        at += len(mark)
        nameless = sizes >= NAMELESS
        yield part, place, [None if x else i for i, x in zip(names.tolist(), nameless.tolist(), strict=True)], (sizes & ~NAMELESS).astype(np.int64), n_ids, offsets, words


def ids_between(part, first: int, last: int) -> np.ndarray:
    """Ids first to last (exclusive, counted in the segment) of one of segments_of(), from the blocks that hold them alone."""
    *_, n, offsets, words = part
    begin = first // BLOCK
    return decode_blocks(words, offsets, n, begin, -(-last // BLOCK))[first - begin * BLOCK : last - begin * BLOCK] if first < last else np.zeros(0, np.uint32)


def _encode(batches, path: str, last_id: int):
    """Segments of this range; places count from its first id."""
    e, place, part = encoder(path), 0, TaskContext.get().partitionId()
    names, held, n = [], [], 0

    def close():
        nonlocal names, held, n, place
        row = pa.RecordBatch.from_arrays([pa.array([segment(names, [len(x) for x in held], np.concatenate(held), place, part)], pa.binary())], ["bytes"])
        place, names, held, n = place + n, [], [], 0
        return row

    for batch in batches:
        for some in slices([batch], "text"):
            for name, ids in zip(some.column("doc_id").to_pylist(), e.encode([t or "" for t in some.column("text").to_pylist()]), strict=True):
                names.append(name)
                held.append(np.append(ids, np.uint32(last_id)).astype(np.uint32))
                n += len(held[-1])
                if n >= SEGMENT:
                    yield close()
    if names:
        yield close()


def _sizes(batches):
    """The range of each file, and how many ids of it the file holds."""
    for batch in batches:
        for content in batch.column("content"):
            found = [(s[0], s[4]) for s in segments_of(content.as_py())]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["part", "ids"])


def write_ids(docs: DataFrame, path: str, tokenizer: str, last_id: int = 2) -> None:
    """Write the ids of all texts, each closed by last_id, under `path` in ascending doc_id order: files in path/ids, their index in path/index.

    Null and empty texts are last_id alone. Rows without a doc_id come first;
    rows that share one are ordered by the hash of their text and all written.
    Other columns are ignored. An empty table leaves files without segments.
    """
    spark = docs.sparkSession
    ship(spark)
    keys = ["doc_id", "_text", "_row"]  # the last two spread a doc_id that many rows share
    sorted_ = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("_text"), F.monotonically_increasing_id().alias("_row")).repartitionByRange(*keys).sortWithinPartitions(*keys)
    made = sorted_.select("doc_id", "text").mapInArrow(lambda it: _encode(it, tokenizer, last_id), "bytes binary")
    made.select(F.col("bytes").cast("string")).write.mode("overwrite").option("lineSep", MARK).option("maxRecordsPerFile", SEGMENTS).text(f"{path}/ids")
    sizes = spark.read.format("binaryFile").load(f"{path}/ids").select("content").mapInArrow(_sizes, "part long, ids long").groupBy("part").agg(F.sum("ids").alias("ids"))
    # a row for each range
    sizes.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before")).write.mode("overwrite").parquet(f"{path}/index")


def _read(batches, with_ids: bool):
    kinds = [("part", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), *([("ids", pa.list_(pa.int64()))] if with_ids else [])]
    for batch in batches:
        for content in batch.column("content"):
            for part, place, names, sizes, n, offsets, words in segments_of(content.as_py()):
                ids = decode_blocks(words, offsets, n).astype("<u4")
                ends = np.cumsum(sizes)
                begins = ends - sizes
                raw = memoryview(ids.tobytes())
                columns = [np.full(len(names), part), names, place + begins, sizes, [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]]
                arrays = [pa.array(c, t) for c, (_, t) in zip(columns, kinds, strict=False)]
                if with_ids:
                    arrays.append(pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(arrays, [k for k, _ in kinds])


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Per document of the files under `path`: doc_id, start (ids before it), n_tokens, ids_crc32 and, if asked for, ids."""
    ship(spark)
    files = spark.read.format("binaryFile").load(f"{path}/ids").select("content")
    rows = files.mapInArrow(lambda it: _read(it, with_ids), "part long, doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else ""))
    # the index has a row for each range
    placed = rows.join(F.broadcast(spark.read.parquet(f"{path}/index")), "part")
    return placed.select("doc_id", (F.col("start") + F.col("before")).alias("start"), *rows.columns[3:])
