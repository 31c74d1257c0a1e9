"""Connectors: ways along lines from places off a network to where they come near it, in the order of the places' ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import metres
from ..storage import cut
from .grid import box_cells, nearest_point, point_cells

#: Steps that ways are followed by in one job.
STEPS = 4


def _pairs(points: DataFrame, targets: DataFrame, reach_m: float) -> DataFrame:
    """points and targets (x, y) within reach, the other columns of both. The point is the centre."""
    t = targets.withColumnsRenamed({"x": "tx", "y": "ty"}).withColumns({"min_x": F.col("tx"), "max_x": F.col("tx"), "min_y": F.col("ty"), "max_y": F.col("ty")})
    met = point_cells(points, reach_m).join(box_cells(t, reach_m), ["cx", "cy"])
    met = met.where(metres(F.col("x"), F.col("y"), F.col("tx") + F.col("shift"), F.col("ty")) <= reach_m)
    return met.drop("x", "y", "tx", "ty", "min_x", "max_x", "min_y", "max_y", "cx", "cy", "shift")


def _near(points: DataFrame, targets: DataFrame, reach_m: float, key: str) -> DataFrame:
    """The keys of the points within reach of a target (x, y)."""
    return _pairs(points.select(key, "x", "y"), targets.select("x", "y"), reach_m).distinct()


def relaxed(known: DataFrame, goals: DataFrame, both: DataFrame, limit: float, rounds: int = 1000) -> DataFrame:
    """known (node, at: cost and next vertex of the cheapest way to a goal) with further goals (node), whose cost is 0.

    Each node has one label however many ways lead over it. Only nodes whose
    cost fell are sent on, along both (node, b, w); ways above `limit` aren't
    kept. Of equally cheap ways the one by the smaller next vertex counts.
    """
    at = F.struct(F.lit(0.0).alias("cost"), F.lit(None).cast("long").alias("next")).alias("at")
    offers, fallen = goals.select("node", at), None
    for _ in range(rounds):
        best = offers.groupBy("node").agg(F.min("at").alias("new")).join(known, "node", "left")
        if fallen is not None:
            # what has fallen already is little, so the whole table is written but once
            best = best.join(fallen.groupBy("node").agg(F.min("at").alias("lower")), "node", "left").withColumn("at", F.coalesce("lower", "at"))
        better = cut(best.where("at is null or new < at").select("node", F.col("new").alias("at"), (F.col("at").isNull() | (F.col("new.cost") < F.col("at.cost"))).alias("fell")))
        if better.isEmpty():
            if fallen is None:
                return known
            lowest = fallen.groupBy("node").agg(F.min("at").alias("at"))
            return cut(known.join(lowest, "node", "left_anti").unionByName(lowest))
        fallen = better.select("node", "at") if fallen is None else fallen.unionByName(better.select("node", "at"))
        cost = F.col("at.cost") + F.col("w")
        offers = better.where("fell").join(both, "node").where(cost <= limit).select(F.col("b").alias("node"), F.struct(cost.alias("cost"), F.col("node").alias("next")).alias("at"))
    raise RuntimeError(f"labels did not settle in {rounds} rounds")


def followed(starts: DataFrame, known: DataFrame) -> DataFrame:
    """starts (anchor, node) with way: the vertices from node to the goal that its label leads to. As long as `limit` allows."""
    turn = known.select(F.col("node").alias("last"), F.col("at.next").alias("next"))
    open_ = starts.select("anchor", F.array("node").alias("way"), F.col("node").alias("last"))
    done = None
    while True:
        for _ in range(STEPS):
            step = open_.join(turn, "last", "left")
            open_ = step.select("anchor", F.when(F.col("next").isNull(), F.col("way")).otherwise(F.concat("way", F.array("next"))).alias("way"), F.col("next").alias("last"))
        open_ = cut(open_)
        ended = open_.where("last is null").select("anchor", "way")
        done = ended if done is None else done.unionByName(ended)
        open_ = open_.where("last is not null")
        if open_.isEmpty():
            return done


def _reached(starts: DataFrame, both: DataFrame, limit: float) -> DataFrame:
    """(anchor, vertex, cost): the vertices that a way of each anchor (anchor, node) of at most `limit` can lead over, each with its least cost."""
    known = front = cut(starts.select("anchor", F.col("node").alias("vertex"), F.lit(0.0).alias("cost")))
    while not front.isEmpty():
        sent = front.join(both, F.col("vertex") == F.col("node")).select("anchor", F.col("b").alias("vertex"), (F.col("cost") + F.col("w")).alias("cost")).where(F.col("cost") <= limit)
        sent = sent.groupBy("anchor", "vertex").agg(F.min("cost").alias("cost"))
        lower = cut(sent.join(known.withColumnRenamed("cost", "was"), ["anchor", "vertex"], "left").where("was is null or cost < was").select("anchor", "vertex", "cost"))
        known = cut(known.unionByName(lower).groupBy("anchor", "vertex").agg(F.min("cost").alias("cost")))
        front = lower
    return known


def _held_up(open_: DataFrame, reached: DataFrame, beside: DataFrame, around: DataFrame) -> DataFrame:
    """The anchors that a lower one may still matter to.

    open_: anchor, cost (no more than this will its way cost). reached: the
    vertices that ways can lead over; beside: vertices (vertex) whose way makes
    others (goal) part of the network; around: vertices whose way puts an anchor
    on the network. Each vertex keeps the lowest anchor whose way can come
    there, so anchors aren't paired.
    """
    # a little more than the cost, as it is added up from the other end
    can = reached.join(open_.select("anchor", F.col("cost").alias("most")), "anchor").where(F.col("cost") <= F.col("most") * (1 + 1e-9) + 1e-6).select("anchor", "vertex")
    first = can.groupBy("vertex").agg(F.min("anchor").alias("first"))
    goals = first.join(beside, "vertex").groupBy("goal").agg(F.min("first").alias("first")).withColumnRenamed("goal", "vertex")
    met = can.join(goals, "vertex").unionByName(around.join(first, "vertex").select("vertex", "anchor", "first"))
    return met.where("first < anchor").select("anchor").distinct()


def connectors(anchors: DataFrame, nodes: DataFrame, vertices: DataFrame, edges: DataFrame, gap_m: float, stitch_m: float, limit: float, rounds: int = 1000) -> DataFrame:
    """(anchor, round, step, vertex, x, y): ways along lines from anchors far off the network to where they come near it; step 0 is where a way begins.

    anchors, nodes: id, x, y. vertices: id, x, y; edges: a, b, cost between
    vertices, in metres and no less than the straight line. In the order of
    their ids, each anchor further than gap_m from all nodes starts at its
    nearest vertex and goes the cheapest way of at most `limit` to a vertex
    within stitch_m of a node; the vertices of the way are nodes from then on.
    Anchors without such a way are left off.

    Vertices keep one label each, the cheapest way to the network, and labels
    are relaxed again from what joins it. A round settles all anchors that no
    lower one's way can come to any more, at least the lowest; so the result is
    that of going through them one by one. Which vertices a way can lead over is
    known from the start and holds less the less it may cost, so the number of
    rounds follows the longest row of anchors whose ways can meet, in the order
    of their ids.
    """
    spark = anchors.sparkSession
    both = cut(edges.where("a <> b and cost is not null").select(F.col("a").alias("node"), "b", F.col("cost").alias("w")).unionByName(edges.where("a <> b and cost is not null").select(F.col("b").alias("node"), F.col("a").alias("b"), F.col("cost").alias("w"))))
    place = cut(vertices.select(F.col("id").alias("node"), "x", "y"))
    rows = anchors.select(F.col("id").alias("anchor"), "x", "y")
    far = cut(rows.join(_near(rows, nodes, gap_m, "anchor"), "anchor", "left_anti"))
    starts = nearest_point(far.withColumnRenamed("anchor", "id"), vertices, 4 * gap_m).select(F.col("id").alias("anchor"), F.col("target").alias("node"))
    open_ = cut(far.select("anchor").join(starts, "anchor"))
    reached = _reached(open_, both, limit * (1 + 1e-9) + 1e-6)
    spots = reached.select("vertex").distinct().join(place.withColumnRenamed("node", "vertex"), "vertex")
    beside = cut(_pairs(place.withColumnRenamed("node", "goal"), spots, stitch_m))
    around = cut(_pairs(far, spots, gap_m))
    known = spark.createDataFrame([], "node long, at struct<cost:double,next:long>")
    goals, out = _near(place, nodes, stitch_m, "node"), None
    for turn in range(rounds):
        known = relaxed(known, goals, both, limit)
        # without a way yet, it may get one of up to the limit
        now = cut(open_.join(known, "node", "left").select(open_["*"], F.coalesce("at.cost", F.lit(limit)).alias("cost"), F.col("at").isNotNull().alias("has_way")))
        ready = cut(now.join(_held_up(now, reached, beside, around), "anchor", "left_anti"))
        ways = followed(ready.where("has_way").select("anchor", "node"), known).select("anchor", F.lit(turn).alias("round"), F.posexplode("way").alias("step", "vertex"))
        ways = cut(ways)
        out = ways if out is None else out.unionByName(ways)
        fresh = ways.select("vertex").distinct()
        gone = ready.select("anchor").unionByName(around.join(fresh, "vertex").select("anchor"))
        open_ = cut(open_.join(gone, "anchor", "left_anti"))
        if open_.isEmpty():
            return out.join(place.withColumnRenamed("node", "vertex"), "vertex").select("anchor", "round", "step", "vertex", "x", "y")
        goals = beside.join(fresh, "vertex").select(F.col("goal").alias("node")).distinct()
    raise RuntimeError(f"connectors did not settle in {rounds} rounds")
