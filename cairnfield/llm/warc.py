"""WARC archives compressed record by record with a shared dictionary.

Each file begins with a skippable frame that holds the Zstandard dictionary,
then has one frame per record, so a reader can start at any record once it has
the dictionary. Records go through Spark's own file writer, one frame per row:
an empty skippable frame divides the rows, which leaves every file a valid
Zstandard stream and gives it Spark's commit protocol, so the task of a lost
executor is simply run again.
"""

from __future__ import annotations

import hashlib
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, smallest

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
#: The empty skippable frame between rows; its bytes are all ASCII.
DIVIDER = struct.pack("<II", 0x184D2A50, 0)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

#: The dictionary is built from at most this many records and bytes of each, whatever the size of the table.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 1_000, 16 << 10, 64 << 10
LEAST_PAYLOAD = 100


def record(page_id, url, payload: bytes, digest: str, refers_to, refers_url=None) -> bytes:
    """One WARC record. refers_to: the page whose response has the same payload; then the payload is left out."""
    revisit = refers_to is not None
    body = b"" if revisit else payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {_one_line(url)}"] if url is not None else []),
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
        *([f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"] if revisit else []),
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(body)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _one_line(url: str) -> str:
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and body of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a record's length is not what its header says")
    return fields, rest[:n]


def dictionary(pages: DataFrame) -> bytes:
    """Dictionary trained on the records of a bounded sample: the pages with the smallest hash of content. Empty if they are too few."""
    sample = smallest(pages.where("html <> ''").select("html", F.col("url").cast("string").alias("url")), F.xxhash64("html", "url"), SAMPLE_RECORDS).select(F.substring("html", 1, SAMPLE_BYTES).alias("html"), "url")
    samples = [record(i, r["url"], p := r["html"].encode()[:SAMPLE_BYTES], hashlib.sha256(p).hexdigest(), None) for i, r in enumerate(sample.collect())]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _write(batches, held, level: int):
    """Frames of one file: the dictionary first, then a frame for each record."""
    data = held.value
    coder = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(data) if data else None, write_content_size=True)
    begun = False
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            frames = []
            if not begun:
                frames.append(struct.pack("<II", DICTIONARY_FRAME, len(data)) + data)
                begun = True
            rows = batch.slice(at, 64).to_pydict()
            for page, url, html, digest, refers in zip(rows["page_id"], rows["url"], rows["html"], rows["digest"], rows["refers_to"], strict=True):
                frames.append(coder.compress(record(page, url, (html or "").encode(), digest, refers)))
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["frame"])


def plan(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest and refers_to: for a page whose payload of LEAST_PAYLOAD bytes or more an earlier page_id has, that page's smallest id; else null."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    base = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html"), F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("bytes"))
    # only payloads that more than one page has; counted before anything else moves
    first = base.where(F.col("bytes") >= LEAST_PAYLOAD).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    joined = base.join(first, "digest", "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "html", "digest", refers.alias("refers_to"))


def write_archives(pages: DataFrame, path: str, level: int = 3) -> None:
    """Write a .warc.zst stream per task under `path` (any file system that Spark writes to).

    Null html is an empty payload; null urls are left out; every row gives one
    record, repeated rows too. Among rows that repeat the smallest page_id of a
    payload each is a response. An empty table gives no records.
    """
    spark = pages.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(dictionary(pages))
    frames = plan(pages).mapInArrow(lambda it: _write(it, held, level), "frame binary")
    frames.select(F.col("frame").cast("string")).write.mode("overwrite").option("lineSep", DIVIDER.decode("ascii")).text(path)


def frames_of(data: bytes):
    """The dictionary's and the records' frames of a file, as (is dictionary, bytes)."""
    view, at = memoryview(data), 0
    while at < len(data):
        magic, size = struct.unpack_from("<II", data, at)
        if magic in SKIPPABLE:
            if magic == DICTIONARY_FRAME:
                yield True, bytes(view[at + 8 : at + 8 + size])
            at += 8 + size
        else:
            end = frame_end(data, at)
            yield False, bytes(view[at:end])
            at = end


def frame_end(data: bytes, at: int) -> int:
    """Where the Zstandard frame that begins at `at` ends, from its header and block headers alone."""
    flags = data[at + 4]
    single = flags >> 5 & 1
    at += 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + ((1 if single else 0), 2, 4, 8)[flags >> 6]
    while True:
        block = int.from_bytes(data[at : at + 3], "little")
        at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        if block & 1:
            return at + 4 * (flags >> 2 & 1)


def _read(batches):
    kinds = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())]
    number = lambda x: int(x[10:-1]) if x and x != "<urn:page:>" else None
    for batch in batches:
        for content in batch.column("content"):
            coder, rows, held = zstandard.ZstdDecompressor(), [], 0

            def out(rows):
                return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(kinds)], [n for n, _ in kinds])

            for is_dictionary, frame in frames_of(content.as_py()):
                if is_dictionary:
                    coder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(frame) if frame else None)
                    continue
                fields, body = parse(coder.decompress(frame))
                kind = fields["WARC-Type"]
                digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                if kind == "response" and (hashlib.sha256(body).hexdigest() != digest or len(body) != int(fields["X-Payload-Length"])):
                    raise ValueError(f"payload of {fields['WARC-Record-ID']} is not what its header says")
                rows.append((number(fields["WARC-Record-ID"]), int(fields["X-Payload-Length"]), digest, kind, number(fields.get("WARC-Refers-To")), fields.get("WARC-Target-URI"), body if kind == "response" else None))
                held += len(body)
                if held > 4 << 20:
                    yield out(rows)
                    rows, held = [], 0
            if rows:
                yield out(rows)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of all archives under `path`: page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload (null for revisits). Digests and lengths of responses are verified."""
    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary")
