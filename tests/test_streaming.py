"""The change feed as a stream equals its batch twin."""

import tempfile

from pyspark.sql import functions as F

from cairnfield.sources import views as V
from cairnfield.streaming import feed
from tests.conftest import DATA


def test_stream_equals_batch(spark):
    rows = V.feed(spark, f"{DATA}/sf0.001")
    folder = tempfile.mkdtemp(prefix="spark-feed-", dir="/tmp")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{folder}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
    q = feed.change_stream(stream).writeStream.format("memory").queryName("feed_out").outputMode("append").option("checkpointLocation", f"{folder}/cp").start()
    q.processAllAvailable()
    q.stop()
    got = sorted(map(str, spark.table("feed_out").select("key", "event_id", "value", "previous").collect()))
    assert got == sorted(map(str, feed.changed_versions(rows).collect()))


def test_redelivered_versions_are_dropped(spark):
    rows = V.feed(spark, f"{DATA}/sf0.001").limit(50)
    folder = tempfile.mkdtemp(prefix="spark-feed-", dir="/tmp")
    rows.unionAll(rows).coalesce(1).write.parquet(f"{folder}/in")
    stream = feed.fresh_versions(spark.readStream.schema(rows.schema).parquet(f"{folder}/in"), "60 days")
    q = stream.writeStream.format("memory").queryName("fresh_out").option("checkpointLocation", f"{folder}/cp").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("fresh_out").count() == rows.count()


def test_snapshot_arrivals(spark):
    folder = tempfile.mkdtemp(prefix="spark-feed-", dir="/tmp")
    schema = "id long, name string"
    spark.createDataFrame([(1, "a"), (2, "b")], schema).coalesce(1).write.parquet(f"{folder}/in")
    arrivals = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    q = feed.snapshot_changes(spark, arrivals, f"{folder}/out", f"{folder}/cp", "id", ["name"])
    q.processAllAvailable()
    spark.createDataFrame([(2, "c"), (3, "d")], schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    q.processAllAvailable()
    q.stop()
    got = {(r["id"], r["kind"]) for r in spark.read.parquet(f"{folder}/out/changes").where(F.col("batch") > 0).collect()}
    assert got == {(1, "removed"), (2, "changed"), (3, "added")}


def test_quiet_keys(spark):
    folder = tempfile.mkdtemp(prefix="spark-feed-", dir="/tmp")
    schema = "key long, ts timestamp_ntz, event_id long, value string"
    rows = [(1, "2024-01-01 00:00:00", 1), (1, "2024-01-01 06:00:00", 2), (2, "2024-01-01 00:00:00", 3), (2, "2024-01-04 00:00:00", 4), (3, "2024-01-09 00:00:00", 5)]
    spark.createDataFrame(rows, "key long, ts string, event_id long").selectExpr("key", "cast(ts as timestamp_ntz) ts", "event_id", "'v' value").coalesce(1).write.parquet(f"{folder}/in")
    stream = feed.quiet_keys(spark.readStream.schema(schema).parquet(f"{folder}/in"))
    q = stream.writeStream.format("memory").queryName("quiet_out").outputMode("append").option("checkpointLocation", f"{folder}/cp").start()
    q.processAllAvailable()
    q.stop()
    got = sorted((r["key"], str(r["last_seen"])[:10], r["versions"]) for r in spark.table("quiet_out").collect())
    # the last run is still open: nothing later has come
    assert got == [(1, "2024-01-01", 2), (2, "2024-01-01", 1), (2, "2024-01-04", 1)]
