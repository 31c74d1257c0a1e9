"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..storage import cut, shared_folder, stored  # noqa: F401

#: Bytes of text that one step inside a task handles at a time.
SLICE_BYTES = 2 << 20

_ROOT = Path(__file__).resolve().parents[1]


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per Spark application."""
    context = spark.sparkContext
    if getattr(context, "_cairnfield_shipped", False):
        return
    name = f"cairnfield_{os.getpid()}.zip"
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for path in sorted(_ROOT.rglob("*.py")):
            z.write(path, f"{_ROOT.name}/{path.relative_to(_ROOT)}")
    import tempfile

    place = Path(tempfile.mkdtemp(prefix="cairnfield-")) / name  # staged on the driver, fetched by the executors
    place.write_bytes(held.getvalue())
    context.addPyFile(str(place))
    context._cairnfield_shipped = True


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fan_out(spark: SparkSession) -> int:
    """Groups to deal a table into: follows the shuffle partitions, which the user sizes by the input."""
    return max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with about `most` bytes of `column` each; a longer value is a part of its own."""
    import numpy as np

    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(np.diff(text_buffers(batch.column(column))[1]))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
            yield batch.slice(at, upto - at)
            at = upto


def text_buffers(column: pa.Array):
    """Bytes of all values of a string or binary column, one after the other, and where each begins (one more at the end). Null counts as empty."""
    import numpy as np
    import pyarrow.compute as pc

    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


#: Bitmaps that tell which rows are looked for: so many parts of 32,768 bits each, whatever the tables hold.
BITMAPS = 1024


def probably_in(rows: DataFrame, wanted: DataFrame, own: list[str], other: list[str]) -> DataFrame:
    """The rows whose columns `own` may be the columns `other` of a wanted row: none of those is left out, few others stay.

    Goes before a join that would shuffle wide rows of which few are wanted.
    What is sent to the tasks is a bit for each hash value, 4 MB at most.
    """
    from pyspark.sql import functions as F

    at = lambda names: F.pmod(F.xxhash64(*names), F.lit(BITMAPS * 32768))
    bit = wanted.select(at(other).alias("bit"))
    maps = bit.groupBy(F.bitmap_bucket_number("bit").alias("_part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("_bits"))
    place = F.bitmap_bit_position(at(own))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    met = rows.join(F.broadcast(maps), F.bitmap_bucket_number(at(own)) == F.col("_part"))
    return met.where(byte.bitwiseAND(F.pow(F.lit(2), F.pmod(place, F.lit(8))).cast("int")) != 0).select(*[F.col(f"`{c}`") for c in rows.columns])


def smallest(df: DataFrame, key, most: int) -> DataFrame:
    """At most `most` rows of df, those whose hash `key` (a long column) is smallest: a sample that is the same on every run.

    Rows far above the cut are dropped where they are read, so what is sorted
    and gathered follows `most`, not the table.
    """
    from pyspark.sql import functions as F

    n = df.count()
    if n > most:
        share = min(1.0, (most + 6 * most**0.5 + 20) / n)
        df = df.where(key <= F.lit(int(-(2**63) + share * (2**64 - 1) * (1 - 2**-50))))
    return df.withColumn("_turn", key).orderBy("_turn").limit(most).drop("_turn")
