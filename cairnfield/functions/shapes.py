"""Column functions on whole geometries, nested: struct<kind, parts: parts of rings of positions (x, y)>.

A point is a part of one position, a line a part of one ring, an area a part of
its rings: one form for every kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .geo import rounded_each

SHAPE = "struct<kind:string,parts:array<array<array<struct<x:double,y:double>>>>>"


def nested(vertices: DataFrame, keys: list[str], kind: Column) -> DataFrame:
    """(keys, shape) of vertices (keys, part, ring, seq, x, y); a row holds one shape whole, as a file of features does."""
    rings = vertices.groupBy(*keys, "part", "ring").agg(F.array_sort(F.collect_list(F.struct("seq", "x", "y"))).alias("p"))
    rings = rings.withColumn("p", F.transform("p", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))))
    parts = rings.groupBy(*keys, "part").agg(F.array_sort(F.collect_list(F.struct("ring", "p"))).alias("r")).withColumn("r", F.col("r.p"))
    whole = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("part", "r"))).alias("s"))
    return whole.select(*keys, F.struct(kind.alias("kind"), F.col("s.r").alias("parts")).alias("shape"))


def _each_ring(shape: Column, f) -> Column:
    return F.transform(shape["parts"], lambda part: F.transform(part, f))


def rounded_shape(shape: Column, places: int = 7) -> Column:
    """shape with all coordinates rounded, as by rounded_each()."""

    def ring(positions: Column) -> Column:
        x, y = rounded_each(F.transform(positions, lambda p: p["x"]), places), rounded_each(F.transform(positions, lambda p: p["y"]), places)
        return F.zip_with(x, y, lambda a, b: F.struct(a.alias("x"), b.alias("y")))

    return F.when(shape.isNotNull(), F.struct(shape["kind"].alias("kind"), _each_ring(shape, ring).alias("parts")))


def canonical_json(shape: Column, places: int = 7) -> Column:
    """The same text for the same shape: keys in order, coordinates rounded and written as whole numbers of the last place."""
    unit = F.lit(float(10**places))
    whole = lambda v: F.round(v * unit).cast("long")

    def ring(positions: Column) -> Column:
        x, y = rounded_each(F.transform(positions, lambda p: p["x"]), places), rounded_each(F.transform(positions, lambda p: p["y"]), places)
        return F.zip_with(x, y, lambda a, b: F.array(whole(a), whole(b)))

    return F.when(shape.isNotNull(), F.to_json(F.struct(shape["kind"].alias("kind"), _each_ring(shape, ring).alias("parts"))))


def shape_hash(shape: Column, places: int = 7) -> Column:
    """SHA-256 of the canonical text: what tells shapes apart, and puts them in a total order."""
    return F.sha2(canonical_json(shape, places), 256)
