"""Trails built from named segments: which pieces a list of keys, parts and cuts stands for, and what is wrong with it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import metres
from ..storage import cut
from .checks import violations
from .graph import assembled, untidy

# How near a cut is to a vertex and pieces to each other; how far a length may be from the stated one (0.05 miles).
REACH_M, TOLERANCE_M = 5.0, 80.4672


def _judged(source: DataFrame, wanted: DataFrame, reach_m: float) -> tuple[DataFrame, DataFrame]:
    """wanted with why it can't be had (null: it can) and the vertex of its cut; and the vertices of what can."""
    held = source.groupBy("fid").agg(F.count_distinct("row").alias("features"), (F.max("part") + 1).alias("parts"))
    w = wanted.join(held, "fid", "left")
    why = F.when(F.col("features").isNull(), "not in the layer").when(F.col("features") > 1, "in the layer twice")
    why = why.when(F.col("part").isNotNull() & ~F.col("part").between(0, F.col("parts") - 1), "no such part")
    why = why.when(F.col("side").isNotNull() & F.col("part").isNull() & (F.col("parts") > 1), "cut in a segment of several parts")
    w = cut(w.withColumn("why", why))
    asked = w.where("why is null").select("trail", "nth", "fid", F.col("part").alias("only"), "side", F.col("x").alias("cut_x"), F.col("y").alias("cut_y"))
    v = source.select("fid", "part", "seq", "x", "y").join(asked, "fid").where("only is null or only = part")
    near = v.where("side is not null").groupBy("trail", "nth").agg(F.min(F.struct(metres(F.col("cut_x"), F.col("cut_y"), F.col("x"), F.col("y")).alias("m"), "seq")).alias("t"))
    near = cut(near.select("trail", "nth", F.col("t.m").alias("m"), F.col("t.seq").alias("at")))
    w = w.join(near, ["trail", "nth"], "left").withColumn("why", F.coalesce("why", F.when(F.col("side").isNotNull() & F.coalesce(F.col("m") > reach_m, F.lit(True)), "no vertex near its cut")))
    return w, v.join(near, ["trail", "nth"], "left").where(F.col("side").isNull() | (F.col("m") <= reach_m))


def trail_pieces(source: DataFrame, wanted: DataFrame, reach_m: float = REACH_M) -> DataFrame:
    """(trail, nth, part, seq, x, y): vertices of the pieces that trails are made of, in their order.

    source: row (one for each feature), fid, part (from 0), seq, x, y. wanted:
    trail, nth, fid, part (null: all), side ("until" or "from" the vertex
    nearest to x, y; null: all of it). Both sides of a cut keep its vertex; of
    equally near ones the first counts. What trail_faults() names is left out.
    """
    _, v = _judged(source, wanted, reach_m)
    kept = v.where("side is null or (side = 'until' and seq <= at) or (side = 'from' and seq >= at)")
    return kept.select("trail", "nth", "part", "seq", "x", "y")


def trail_faults(source: DataFrame, wanted: DataFrame, reach_m: float = REACH_M) -> DataFrame:
    """(trail, nth, fid, why): rows of wanted that can't be had: the key is not in the layer, or there twice, or has no such part, or is cut without a part being named, or at no vertex within reach."""
    return _judged(source, wanted, reach_m)[0].where("why is not null").select("trail", "nth", "fid", "why")


def checked_trails(source: DataFrame, wanted: DataFrame, lengths_m: DataFrame, reach_m: float = REACH_M, tolerance_m: float = TOLERANCE_M) -> tuple[DataFrame, DataFrame]:
    """The vertices of all trails, and every fault as (check_name, key): in the list, in one that falls into several parts, in one whose length isn't the stated one (trail, wanted_m)."""
    pieces = cut(trail_pieces(source, wanted, reach_m))
    whole = assembled(pieces.select("trail", F.struct("nth", "part").alias("line"), "seq", "x", "y"), reach_m)
    listed = trail_faults(source, wanted, reach_m).select(F.col("why").alias("check_name"), F.concat_ws(": ", F.col("trail").cast("string"), F.col("fid").cast("string")).alias("key"))
    empty = violations({"without pieces": wanted.select("trail").distinct().join(pieces.select("trail").distinct(), "trail", "left_anti")}, "trail")
    return pieces, listed.unionByName(untidy(whole, lengths_m, tolerance_m)).unionByName(empty)
