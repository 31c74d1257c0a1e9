"""Change feeds: each arriving version of a key against the one before it."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def changed_versions(feed: DataFrame) -> DataFrame:
    """Batch twin: (key, event_id, value, previous) for versions that differ from the key's last; its first has previous null."""
    w = Window.partitionBy("key").orderBy("ts", "event_id")
    return feed.withColumn("previous", F.lag("value").over(w)).where("previous is null or previous <> value").select("key", "event_id", "value", "previous")


def change_stream(feed: DataFrame) -> DataFrame:
    """The same over a stream: key, ts, event_id, value in; state is each key's last value. Versions of a key are taken in order inside a batch; batches in order of arrival."""
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = []
        for event_id, value in pd.concat(list(frames)).sort_values(["ts", "event_id"])[["event_id", "value"]].itertuples(index=False):
            if value != last:
                rows.append((key[0], event_id, value, last))
                last = value
        state.update((last,))
        yield pd.DataFrame(rows, columns=["key", "event_id", "value", "previous"])

    return feed.groupBy("key").applyInPandasWithState(step, "key long, event_id long, value string, previous string", "last string", "append", GroupStateTimeout.NoTimeout)


def _timed(feed: DataFrame) -> DataFrame:
    """Watermarks need a time with a zone."""
    return feed.withColumn("ts", F.col("ts").cast("timestamp"))


def fresh_versions(feed: DataFrame, delay: str = "1 hour") -> DataFrame:
    """A stream without re-delivered versions (same event_id within `delay`)."""
    return _timed(feed).withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])


def quiet_keys(feed: DataFrame, gap: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """(key, last_seen, versions): runs of versions of a key, closed once nothing new came for `gap`: the key is stale from then on."""
    runs = _timed(feed).withWatermark("ts", delay).groupBy("key", F.session_window("ts", gap).alias("w")).agg(F.max("ts").alias("last_seen"), F.count(F.lit(1)).alias("versions"))
    return runs.select("key", "last_seen", "versions")


def snapshot_changes(spark: SparkSession, arrivals: DataFrame, out: str, checkpoint: str, key: str, fields: list[str]):
    """Compare each arriving snapshot (column snapshot_id, a row per key) with the one before it; changes are written to `out`, one folder for each batch. Returns the running query."""
    from ..operators.diff import keyed_diff

    def each(batch: DataFrame, number: int) -> None:
        last = f"{out}/_last"
        path = spark._jvm.org.apache.hadoop.fs.Path(last)
        held = path.getFileSystem(spark._jsc.hadoopConfiguration())
        now = batch.select(key, *fields)
        slots = sorted(int(s.getPath().getName()) for s in held.listStatus(path)) if held.exists(path) else []
        slots = [s for s in slots if s < number]  # a batch that is run again is compared with the same one
        before = spark.read.parquet(f"{last}/{slots[-1]}") if slots else spark.createDataFrame([], now.schema)
        now.write.mode("overwrite").parquet(f"{last}/{number}")
        now = spark.read.parquet(f"{last}/{number}")
        keyed_diff(before, now, key, fields).where("kind <> 'same'").write.mode("overwrite").parquet(f"{out}/changes/batch={number}")

    return arrivals.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each).start()
