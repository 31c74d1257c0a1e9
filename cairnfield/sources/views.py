"""Feature tables derived from the star-schema tables, by integer arithmetic on their keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def place_x(k: Column) -> Column:
    return F.lit(-93.35) + (k * 7919 % 3001).cast("double") / 1e4


def place_y(k: Column) -> Column:
    # by the remainder of the key, as the square of a key beyond 9.3 million times 104729 is no long
    k = k % 1999
    return F.lit(44.35) + ((k * k * 104729 + k * 31) % 1999).cast("double") / 1e4


def points(spark: SparkSession, folder: str) -> DataFrame:
    """id, x, y, name, kind, nation."""
    k = F.col("c_custkey")
    return table(spark, folder, "customer").select(k.alias("id"), place_x(k).alias("x"), place_y(k).alias("y"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("kind"), F.col("c_nationkey").alias("nation"))


#: Rings of the three shapes: (shape, ring, seq, east, north), in thousandths of a degree.
_SHAPES = [
    *[(0, 0, i, e, n) for i, (e, n) in enumerate([(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)])],
    *[(1, 0, i, e, n) for i, (e, n) in enumerate([(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4), (0, 0)])],
    *[(2, 0, i, e, n) for i, (e, n) in enumerate([(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)])],
    *[(2, 1, i, e, n) for i, (e, n) in enumerate([(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)])],
]


def polygons(spark: SparkSession, folder: str) -> DataFrame:
    """Vertices: id, tier, name, ring (0: outer), seq, x, y."""
    k = F.col("s_suppkey")
    shape = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(s, ("shape", "ring", "seq", "e", "n"), strict=True)]) for s in _SHAPES])
    base = table(spark, folder, "supplier").select(k.alias("id"), (F.col("s_nationkey") % 2).alias("tier"), F.col("s_name").alias("name"), F.explode(F.filter(shape, lambda s: s["shape"] == k % 3)).alias("v"))
    return base.select("id", "tier", "name", F.col("v.ring").alias("ring"), F.col("v.seq").alias("seq"), (place_x(F.col("id")) + 0.00003 + F.col("v.e") / F.lit(1e3)).alias("x"), (place_y(F.col("id")) + 0.00003 + F.col("v.n") / F.lit(1e3)).alias("y"))


def line_vertices(spark: SparkSession, folder: str) -> DataFrame:
    """line, seq (from 0), x, y. Keys repeat in the source, so all columns order them."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    base = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", (F.row_number().over(w) - 1).alias("seq"))
    k = F.col("l_orderkey")
    return base.select(k.alias("line"), "seq", (place_x(k) + (F.col("seq") * 37 + F.col("l_partkey") % 41).cast("double") / 1e5).alias("x"), (place_y(k) + (F.col("l_suppkey") % 23).cast("double") / 1e5).alias("y"))


def snapshot(spark: SparkSession, folder: str, version: str) -> DataFrame:
    """Places of one version, "before" or "after": id, name, type, brand, size, x, y."""
    k = F.col("p_partkey")
    part = table(spark, folder, "part")
    old = version == "before"
    rows = part.where(k % (10 if old else 11) != 0)
    name = F.col("p_name") if old else F.when(k % 7 == 0, F.concat("p_name", F.lit(" new"))).otherwise(F.col("p_name"))
    name_id = k if old else F.when(k % 13 == 0, k + 1_000_000).otherwise(k)
    shift = 0.0 if old else F.when(k % 17 == 0, 0.0001).otherwise(0.0)
    return rows.select(name_id.alias("id"), name.alias("name"), F.col("p_type").alias("type"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"), (place_x(k) + shift).alias("x"), place_y(k).alias("y"))


def context(spark: SparkSession, folder: str, version: str) -> DataFrame:
    """Background shapes of one version, repeats and all: slug, shape."""
    rows = table(spark, folder, "lineitem").where("l_linenumber <= 4" if version == "before" else "l_linenumber >= 3")
    return rows.select(F.concat("l_returnflag", "l_linestatus").alias("slug"), (F.col("l_partkey") % 200).alias("shape"))


def feed(spark: SparkSession, folder: str) -> DataFrame:
    """Arriving versions of keys: key, ts, event_id, value."""
    return table(spark, folder, "events").select(F.col("user_id").alias("key"), "ts", "event_id", F.col("event_type").alias("value"))


def marked_pages(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, html: the pages with their anchors written in four ways (attributes before the address, upper case, nested tags, references)."""
    html, n = F.col("html"), F.col("page_id") % 4
    attributes = F.replace(html, F.lit("<a href="), F.lit('<a class="n"\n HREF='))
    nested = F.replace(F.replace(html, F.lit('<a href="/'), F.lit('<A rel=x href="/news/')), F.lit('">'), F.lit("\" title='x'><i>"))
    references = F.replace(F.replace(html, F.lit('<a href="/'), F.lit('<a href="/&amp;')), F.lit("</a>"), F.lit("&eacute;&#8217;&#x41;&ampx&notit;&bogus;&#150;</a>"))
    return table(spark, folder, "pages").select("page_id", F.when(n == 0, html).when(n == 1, attributes).when(n == 2, nested).otherwise(references).alias("html"))
