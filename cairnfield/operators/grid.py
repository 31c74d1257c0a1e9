"""The grid join: near pairs without a spatial library and without a cross join.

A cell is as wide as the reach, so what lies within reach of a point lies in
its cell or a neighbour. Shapes are put into every cell that their bounds,
widened by the reach, touch; points into theirs; cells are then joined on
equality and distances computed for what met. Each row of cells has a width of
its own in degrees, right for its latitude nearest the pole, so no near pair is
missed at any latitude. Shapes much wider than the reach go to levels of wider
cells, each twice as wide as the one below, so that none fills many; points
look into every level that holds a shape. What lies near the 180th meridian is
put beyond its other end as well (`shift`, in degrees), so pairs across it meet.

Whether a point is inside an area is told from the edges in its own cell of a
grid that each large ring has for itself: the parity of the cell comes from the
edges that cross the middle of its row further east, added up once for a cell.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import LAT_M, LON_M, crosses, metres, nearest_on, scale_x, to_segment, to_segments
from ..storage import cut, stored

#: Reach beyond which nothing on earth lies, in metres.
FARTHEST_M = 4.1e7
#: What to_segment() and nearest_on() take from the rows of near_segments().
SIDE = ("x", "y", "x0", "y0", "x1", "y1", "sx")


def _high(reach_m: float, level: Column | int) -> Column:
    """Height of a cell in degrees."""
    return F.lit(reach_m / LAT_M) * F.pow(F.lit(2.0), F.lit(level) if isinstance(level, int) else level)


def _wide(reach_m: float, level: Column | int, cy: Column) -> Column:
    """Width in degrees of the cells of row cy; at a pole they go all round."""
    high = _high(reach_m, level)
    pole = F.least(F.greatest(F.abs(cy * high), F.abs((cy + 1) * high)), F.lit(90.0))
    return F.least(high * F.lit(LAT_M / LON_M) / F.cos(F.radians(pole)), F.lit(360.0))


def cell(c: Column, step: Column) -> Column:
    return F.floor(c / step).cast("long")


def point_cells(points: DataFrame, reach_m: float, levels: list[int] | None = None) -> DataFrame:
    """points with their cell (cx, cy); with levels once for each, with level."""
    level: Column | int = 0
    if levels is not None:
        points, level = points.withColumn("level", F.explode(F.array(*[F.lit(n) for n in levels]) if levels else F.array().cast("array<int>"))), F.col("level")
    rows = points.withColumn("cy", cell(F.col("y"), _high(reach_m, level)))
    return rows.withColumn("cx", cell(F.col("x"), _wide(reach_m, level, F.col("cy"))))


def leveled(boxes: DataFrame, reach_m: float) -> DataFrame:
    """boxes with the level whose cells are as wide as they."""
    size = F.greatest((F.col("max_x") - F.col("min_x")) * LON_M * F.cos(F.radians(F.least(F.abs("min_y"), F.abs("max_y")))), (F.col("max_y") - F.col("min_y")) * LAT_M, F.lit(reach_m))
    return boxes.withColumn("level", F.ceil(F.log2(size / reach_m)).cast("int"))


def box_cells(boxes: DataFrame, reach_m: float) -> DataFrame:
    """boxes (min_x, min_y, max_x, max_y) once for each cell that they come within reach of; the cells of their level if they have one. shift is what their x have to be moved by to lie there."""
    level: Column | int = F.col("level") if "level" in boxes.columns else 0
    high, reach = _high(reach_m, level), F.lit(reach_m / LAT_M)
    rows = boxes.withColumn("cy", F.explode(F.sequence(cell(F.col("min_y") - reach, high), cell(F.col("max_y") + reach, high))))
    wide = _wide(reach_m, level, F.col("cy"))
    west, east = F.col("min_x") - wide, F.col("max_x") + wide
    around = [F.when(east + s >= -180.0 if s < 0 else west + s <= 180.0, F.lit(s)) for s in (-360.0, 360.0)]
    rows = rows.withColumn("shift", F.explode(F.when(west.between(-180.0, 180.0) & east.between(-180.0, 180.0), F.array(F.lit(0.0))).otherwise(F.array_compact(F.array(F.lit(0.0), *around)))))
    # a cell is at least as wide as the reach
    return rows.withColumn("cx", F.explode(F.sequence(cell(west + F.col("shift"), wide), cell(east + F.col("shift"), wide))))


def _this_side(delta: Column) -> Column:
    """Whether a difference of longitudes is the shorter way round."""
    return (delta > -180.0) & (delta <= 180.0)


def levels_of(boxes: DataFrame) -> list[int]:
    """The levels that hold a box: a few dozen at most, as they double."""
    return sorted(r["level"] for r in boxes.select("level").distinct().collect())


def _point_boxes(points: DataFrame, x: str, y: str) -> DataFrame:
    return points.withColumns({"min_x": F.col(x), "max_x": F.col(x), "min_y": F.col(y), "max_y": F.col(y)})


def dealt(left: DataFrame, right: DataFrame, at: list[str]) -> DataFrame:
    """left and right joined on cells. Both sides look small and what meets is not, so they are in a fixed number of parts, which are not gathered into one task, and neither is broadcast."""
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return left.repartition(parts, *at).join(right.repartition(parts, *at).hint("merge"), at)


def near_points(points: DataFrame, reach_m: float) -> DataFrame:
    """(a, b, m): pairs of points, a < b, within reach; the point with the smaller id is the centre."""
    right = _point_boxes(points.select(F.col("id").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by")), "bx", "by")
    met = dealt(point_cells(points.select("id", "x", "y"), reach_m), box_cells(right, reach_m), ["cx", "cy"]).where("id < b").withColumn("bx", F.col("bx") + F.col("shift")).withColumn("m", metres(F.col("x"), F.col("y"), F.col("bx"), F.col("by")))
    return met.where(_this_side(F.col("bx") - F.col("x"))).where(F.col("m") <= reach_m).select(F.col("id").alias("a"), "b", "m")


def linked_points(points: DataFrame, reach_m: float) -> DataFrame:
    """(node, root): for each point (id, x, y) that lies within reach of another the smallest id that a chain of such pairs leads to: components(near_points()), without most of the pairs.

    The points of a small cell are tied to its first one, the first ones of cells
    to each other. Pairs of points are looked for only where two sets that are
    not tied yet come near each other, so dense places bring no pairs.
    """
    from .graph import components, spread_join

    rows = cut(point_cells(points.select("id", "x", "y"), reach_m / 2))
    first = rows.groupBy("cx", "cy").agg(F.min(F.struct("id", "x", "y")).alias("r"))
    rows = rows.join(first, ["cx", "cy"])
    # at the poles a cell may be wider than the reach: what is too far from the first point stands for itself
    near = metres(F.col("r.x"), F.col("r.y"), F.col("x"), F.col("y")) <= reach_m
    rows = cut(rows.select("id", "x", "y", F.when(near, F.col("r.id")).otherwise(F.col("id")).alias("head")))
    ties = components(near_points(first.select("r.id", "r.x", "r.y"), reach_m))
    several = rows.where("id <> head").select(F.col("head").alias("node")).distinct().withColumn("several", F.lit(True))
    held = rows.join(ties, F.col("head") == F.col("node"), "left").drop("node").join(several, F.col("head") == F.col("node"), "left")
    held = cut(held.select("id", "x", "y", F.coalesce("root", "head").alias("label"), (F.col("root").isNotNull() | F.col("several").isNotNull()).alias("tied")))
    # cells that more than one set comes near to
    right = box_cells(_point_boxes(held.select(F.col("id").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"), F.col("label").alias("other")), "bx", "by"), reach_m)
    mixed = cut(right.groupBy("cx", "cy").agg(F.min("other").alias("lo"), F.max("other").alias("hi")).where("lo <> hi").select("cx", "cy"))
    met = point_cells(held.select("id", "x", "y", "label"), reach_m).join(mixed, ["cx", "cy"]).join(right.join(mixed, ["cx", "cy"], "left_semi"), ["cx", "cy"]).where("id < b and label <> other").withColumn("bx", F.col("bx") + F.col("shift"))
    met = met.where(_this_side(F.col("bx") - F.col("x"))).where(metres(F.col("x"), F.col("y"), F.col("bx"), F.col("by")) <= reach_m).select(F.col("label").alias("a"), F.col("other").alias("b"))
    # an id that stands in several places ties their sets
    twice = held.groupBy("id").agg(F.min("label").alias("a"), F.max("label").alias("hi")).where("a <> hi").select("id", "a").join(held, "id").select("a", F.col("label").alias("b"))
    roots = components(met.unionByName(twice).where("a <> b").distinct()).withColumnRenamed("node", "label")
    found = spread_join(held, roots, "label", "left").where("tied or root is not null")
    return found.groupBy(F.col("id").alias("node")).agg(F.min(F.coalesce("root", "label")).alias("root"))


def _segment_boxes(segments: DataFrame) -> DataFrame:
    return segments.withColumns({"min_x": F.least("x0", "x1"), "max_x": F.greatest("x0", "x1"), "min_y": F.least("y0", "y1"), "max_y": F.greatest("y0", "y1")})


#: Segments are looked up in pieces of so many times the reach, if that takes no more than MOST_PIECES.
PIECE, MOST_PIECES = 4.0, 64


def _piece_corners(segments: DataFrame, reach_m: float) -> DataFrame:
    """segments once for each piece, with the level and the cell of its south-west corner."""
    size = F.hypot((F.col("x1") - F.col("x0")) * LON_M * F.cos(F.radians(F.least(F.abs("y0"), F.abs("y1")))), (F.col("y1") - F.col("y0")) * LAT_M)
    n = F.greatest(F.lit(1), F.least(F.lit(MOST_PIECES), F.ceil(size / (reach_m * PIECE)).cast("int")))
    rows = segments.withColumn("_n", n).withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    at = lambda c, i: F.col(f"{c}0") + (F.col(f"{c}1") - F.col(f"{c}0")) * (i / F.col("_n"))
    first, last = F.col("_i") - 1, F.col("_i")
    rows = rows.withColumns({f"{name}_{c}": pick(at(c, first), at(c, last)) for c in "xy" for name, pick in (("min", F.least), ("max", F.greatest))})
    rows = leveled(rows, reach_m).withColumn("cy", cell(F.col("min_y"), _high(reach_m, F.col("level"))))
    return rows.withColumn("cx", cell(F.col("min_x"), _wide(reach_m, F.col("level"), F.col("cy")))).drop("_n", "_i", "min_x", "max_x", "min_y", "max_y")


def _corners_around(points: DataFrame, reach_m: float, levels: list[int]) -> DataFrame:
    """points once for each cell of each level that holds the corner of what may be within reach. shift is what their x are moved by to lie there."""
    rows = points.withColumn("level", F.explode(F.array(*[F.lit(n) for n in levels]) if levels else F.array().cast("array<int>")))
    # a little more than the reach, for rounding
    reach = F.lit(reach_m / LAT_M * (1 + 1e-6) + 1e-9)
    high = _high(reach_m, F.col("level"))
    rows = rows.withColumn("cy", F.explode(F.sequence(cell(F.col("y") - high - reach, high), cell(F.col("y") + reach, high))))
    # a piece is no larger than a cell of its row
    wide = _wide(reach_m, F.col("level"), F.col("cy"))
    beside = F.least(reach * F.lit(LAT_M / LON_M) / F.cos(F.radians(F.least(F.abs("y"), F.lit(90.0)))), F.lit(360.0))
    west, east = F.col("x") - wide - beside, F.col("x") + beside
    rows = rows.withColumn("shift", F.explode(F.when((west >= -180.0) & (east <= 180.0), F.array(F.lit(0.0))).otherwise(F.array(*[F.lit(s) for s in (0.0, -360.0, 360.0)]))))
    return rows.withColumn("cx", F.explode(F.sequence(cell(west + F.col("shift"), wide), cell(east + F.col("shift"), wide))))


def near_segments(points: DataFrame, segments: DataFrame, reach_m: float, same: tuple[str, ...] = (), few: bool = False) -> DataFrame:
    """points and segments (x0, y0, x1, y1) that may be within reach, all columns of both and sx, the point's scale for SIDE; with same, only those that agree in these columns. A pair may come more than once. Segments from across the 180th meridian have their x moved.

    A segment is one row for each piece, at its corner, and points look into the
    cells around, so of many segments none is written often. few: points are few
    and taken to the segments.
    """
    pieces = _piece_corners(segments, reach_m)
    spots = _corners_around(points.withColumn("sx", scale_x(F.col("y"))), reach_m, levels_of(pieces))
    at = [*same, "level", "cx", "cy"]
    met = pieces.join(F.broadcast(spots), at) if few else dealt(spots, pieces, at)
    return met.withColumns({"x0": F.col("x0") - F.col("shift"), "x1": F.col("x1") - F.col("shift")}).drop("level", "cx", "cy", "shift")


def near_few_segments(points: DataFrame, segments: DataFrame, reach_m: float, same: tuple[str, ...] = ()) -> DataFrame:
    """near_segments() for many points and few segments: these are written into all cells around."""
    boxes = cut(leveled(_segment_boxes(segments), reach_m))
    cells = box_cells(boxes, reach_m).drop("min_x", "max_x", "min_y", "max_y").withColumns({"x0": F.col("x0") + F.col("shift"), "x1": F.col("x1") + F.col("shift")})
    spots = point_cells(points.withColumn("sx", scale_x(F.col("y"))), reach_m, levels_of(boxes))
    return dealt(spots, cells, [*same, "level", "cx", "cy"]).drop("level", "cx", "cy", "shift")


#: Rings of more edges have a grid of their own.
FEW_EDGES = 64


def _in_few(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """pairs (id, x, y, fid, ring) with odd, from all edges of the ring, which are few."""
    args = [F.col(c) for c in ("x", "y", "x0", "y0", "x1", "y1")]
    return pairs.join(edges, ["fid", "ring"]).groupBy("id", "fid", "ring").agg((F.sum(crosses(*args)) % 2).alias("odd"))


def _in_many(pairs: DataFrame, edges: DataFrame, rings: DataFrame) -> DataFrame:
    """pairs (id, x, y, fid, ring) with odd, from the edges in the point's cell and what is known of the cell.

    Cells are as high and wide as the mean edge or so, so edges fill at most a
    few times their number of cells, and a cell holds few of them whatever the
    ring has.
    """
    # the fraction keeps middles off round coordinates
    step = lambda lo, hi, mean: F.greatest(F.col(mean), (F.col(hi) - F.col(lo)) * 16.618 / F.col("edges"), F.lit(1e-12))
    sizes = rings.select("fid", "ring", F.col("min_x").alias("ox"), F.col("min_y").alias("oy"), step("min_x", "max_x", "mean_dx").alias("wide"), step("min_y", "max_y", "mean_dy").alias("high"))
    row = lambda y: cell(y - F.col("oy"), F.col("high"))
    col = lambda x: cell(x - F.col("ox"), F.col("wide"))
    mid = F.col("oy") + (F.col("row") + 0.5) * F.col("high")
    e = edges.join(sizes, ["fid", "ring"])
    e = e.withColumn("row", F.explode(F.sequence(row(F.least("y0", "y1")), row(F.greatest("y0", "y1")))))
    at_y = lambda y: F.col("x0") + (y - F.col("y0")) / F.when(F.col("y1") == F.col("y0"), 1.0).otherwise(F.col("y1") - F.col("y0")) * (F.col("x1") - F.col("x0"))
    hit = F.when((F.col("y0") > mid) != (F.col("y1") > mid), at_y(mid))
    # where the edge runs inside this row, a little widened for rounding
    slack = F.col("wide") * 1e-6
    low, high = F.col("oy") + F.col("row") * F.col("high"), F.col("oy") + (F.col("row") + 1) * F.col("high")
    flat = F.col("y0") == F.col("y1")
    clip = lambda y: F.when(flat, None).otherwise(at_y(F.least(F.greatest(y, F.least("y0", "y1")), F.greatest("y0", "y1"))))
    left = F.when(flat, F.least("x0", "x1")).otherwise(F.least(clip(low), clip(high)))
    right = F.when(flat, F.greatest("x0", "x1")).otherwise(F.greatest(clip(low), clip(high)))
    e = cut(e.withColumn("hit", hit).withColumn("mid", mid).withColumn("col", F.explode(F.sequence(col(left - slack), col(right + slack)))).select("fid", "ring", "row", "col", "x0", "y0", "x1", "y1", "mid", "hit", col(F.col("hit")).alias("hit_col")))
    p = cut(pairs.join(sizes, ["fid", "ring"]).select("id", "fid", "ring", "x", "y", row(F.col("y")).alias("row"), col(F.col("x")).alias("col")))
    # crossings of each row's middle, counted in their cells and added up from the east, for the cells that hold a point
    counts = e.where("hit_col = col").groupBy("fid", "ring", "row", "col").agg(F.count(F.lit(1)).alias("n"))
    asked = p.select("fid", "ring", "row", "col").distinct().withColumn("n", F.lit(0).cast("long"))
    cells = counts.unionByName(asked).groupBy("fid", "ring", "row", "col").agg(F.sum("n").alias("n"), F.count_if(F.col("n") == 0).alias("asked"))
    east = Window.partitionBy("fid", "ring", "row").orderBy(F.col("col").desc()).rowsBetween(Window.unboundedPreceding, -1)
    known = cells.withColumn("further", F.coalesce(F.sum("n").over(east), F.lit(0))).where("asked > 0").select("fid", "ring", "row", "col", "further")
    met = p.join(e, ["fid", "ring", "row", "col"], "left")
    beside = F.when((F.col("hit_col") == F.col("col")) & (F.col("hit") > F.col("x")), 1).otherwise(0)
    at_x = F.col("y0") + (F.col("x") - F.col("x0")) / F.when(F.col("x1") == F.col("x0"), 1.0).otherwise(F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    between = F.when(((F.col("x0") > F.col("x")) != (F.col("x1") > F.col("x"))) & ((at_x > F.col("y")) != (at_x > F.col("mid"))), 1).otherwise(0)
    own = met.groupBy("id", "fid", "ring", "row", "col").agg(F.coalesce(F.sum(beside + between), F.lit(0)).alias("own"))
    return own.join(known, ["fid", "ring", "row", "col"]).select("id", "fid", "ring", ((F.col("own") + F.col("further")) % 2).alias("odd"))


def _rings_in_rows(segments: DataFrame) -> DataFrame:
    """(fid, rings): each area with the edges of its rings."""
    rings = segments.groupBy("fid", "ring").agg(F.collect_list(F.struct("x0", "y0", "x1", "y1")).alias("e"))
    return rings.groupBy("fid").agg(F.collect_list(F.struct("ring", "e")).alias("rings"))


def _holds(rings: Column, x: Column, y: Column) -> Column:
    """Whether a point is inside the outer ring (0) and in no other."""
    odd = lambda r: (F.size(F.filter(r["e"], lambda s: crosses(x, y, s["x0"], s["y0"], s["x1"], s["y1"]) == 1)) % 2 == 1)
    return F.exists(rings, lambda r: (r["ring"] == 0) & odd(r)) & ~F.exists(rings, lambda r: (r["ring"] > 0) & odd(r))


def contained(points: DataFrame, segments: DataFrame, reach_m: float) -> DataFrame:
    """(id, fid): points inside areas, in the outer ring (0) and in no other. segments: fid, ring, x0, y0, x1, y1; reach_m: about how large a small area is, for the grid that finds them. Ids of points are different."""
    segments = segments.select("fid", "ring", "x0", "y0", "x1", "y1")
    boxes = cut(leveled(_area_boxes(segments), reach_m))
    whole, rest = boxes.where(F.col("edges") <= FEW_EDGES), boxes.where(F.col("edges") > FEW_EDGES).select("fid")
    # an area of few edges is one row with its edges in it, so nothing is shuffled after the join
    cells = box_cells(whole, reach_m).join(_rings_in_rows(segments.join(whole.select("fid"), "fid", "left_semi")), "fid")
    met = dealt(point_cells(points.select("id", "x", "y"), reach_m, levels_of(whole)), cells, ["level", "cx", "cy"]).withColumn("x", F.col("x") - F.col("shift"))
    inside = met.where("x between min_x and max_x and y between min_y and max_y").where(_holds(F.col("rings"), F.col("x"), F.col("y"))).select("id", "fid")
    if rest.isEmpty():
        return inside
    return inside.unionByName(_contained_parts(points, segments.join(rest, "fid", "left_semi"), reach_m))


def _area_boxes(segments: DataFrame) -> DataFrame:
    lows, highs = [F.least("x0", "x1"), F.least("y0", "y1")], [F.greatest("x0", "x1"), F.greatest("y0", "y1")]
    return segments.groupBy("fid").agg(F.min(lows[0]).alias("min_x"), F.min(lows[1]).alias("min_y"), F.max(highs[0]).alias("max_x"), F.max(highs[1]).alias("max_y"), F.count(F.lit(1)).alias("edges"))


def _contained_parts(points: DataFrame, segments: DataFrame, reach_m: float) -> DataFrame:
    """contained() for areas of any form, edge by edge."""
    lows, highs = [F.least("x0", "x1"), F.least("y0", "y1")], [F.greatest("x0", "x1"), F.greatest("y0", "y1")]
    rings = segments.groupBy("fid", "ring").agg(F.min(lows[0]).alias("min_x"), F.min(lows[1]).alias("min_y"), F.max(highs[0]).alias("max_x"), F.max(highs[1]).alias("max_y"), F.count(F.lit(1)).alias("edges"), F.avg(F.abs(F.col("x1") - F.col("x0"))).alias("mean_dx"), F.avg(F.abs(F.col("y1") - F.col("y0"))).alias("mean_dy"))
    rings = cut(leveled(rings, reach_m))
    met = dealt(point_cells(points.select("id", "x", "y"), reach_m, levels_of(rings)), box_cells(rings, reach_m), ["level", "cx", "cy"]).withColumn("x", F.col("x") - F.col("shift"))
    pairs = met.where("x between min_x and max_x and y between min_y and max_y").select("id", "x", "y", "fid", "ring", "edges")
    own, is_few = segments.select("fid", "ring", "x0", "y0", "x1", "y1"), F.col("edges") <= FEW_EDGES
    odd = _in_few(pairs.where(is_few).drop("edges"), own)
    many = rings.where(~is_few)
    if not many.isEmpty():
        odd = odd.unionByName(_in_many(pairs.where(~is_few).drop("edges"), own.join(many.select("fid", "ring"), ["fid", "ring"], "left_semi"), many))
    whole = odd.groupBy("id", "fid").agg(F.max(F.when(F.col("ring") == 0, F.col("odd")).otherwise(0)).alias("outer"), F.max(F.when(F.col("ring") > 0, F.col("odd")).otherwise(0)).alias("hole"))
    return whole.where("outer = 1 and hole = 0").select("id", "fid")


def _near_whole(points: DataFrame, boxes: DataFrame, segments: DataFrame, reach_m: float, same: tuple[str, ...] = ()) -> DataFrame:
    """within_polygons() for areas (boxes: fid, same, min_x, min_y, max_x, max_y, level) of few edges, away from the poles and the 180th meridian.

    An area is one row with its edges in it, and a point is in one cell of each
    level, so a pair meets once: nothing is shuffled after the join.
    """
    at = [*same, "level", "cx", "cy"]
    spots = points.select("id", *same, "x", "y").withColumn("sx", scale_x(F.col("y")))
    met = lambda own: dealt(point_cells(spots, reach_m, levels_of(own)), box_cells(own, reach_m).drop("shift"), at)
    flat = segments.groupBy("fid").agg(F.collect_list(F.struct("ring", "x0", "y0", "x1", "y1")).alias("edges"), F.count_distinct(F.when(F.col("ring") != 0, F.col("ring"))).alias("inner"))
    held = cut(boxes.drop("edges").join(flat, "fid"))
    plain, holed = held.where("inner <= 1").drop("inner"), held.where("inner > 1").drop("inner", "edges")
    near = _measured_apart(met(plain), at, reach_m)
    if holed.isEmpty():
        return near
    return near.unionByName(_measured(met(holed.join(_rings_in_rows(segments), "fid")), reach_m))


def _in_box(reach_m: float) -> Column:
    """Whether a point (x, y, sx) may be within reach of an area, by its bounds; a little more than the reach, for rounding."""
    far = F.lit(reach_m * (1 + 1e-6))
    return (F.greatest(F.col("min_x") - F.col("x"), F.col("x") - F.col("max_x")) * F.col("sx") <= far) & (F.greatest(F.col("min_y") - F.col("y"), F.col("y") - F.col("max_y")) * F.lit(LAT_M) <= far)


def _measured_apart(met: DataFrame, at: list[str], reach_m: float) -> DataFrame:
    """_measured() for areas with their edges (edges: an array) and one inner ring at most, edge by edge: rows are dealt out by `at`, so a pair's edges are together where it met and nothing is shuffled. Arrays would be interpreted, edges are compiled."""
    e = met.where(_in_box(reach_m)).select(*at, "id", "fid", "x", "y", "sx", F.explode("edges").alias("e")).select(*at, "id", "fid", "x", "y", "sx", "e.*")
    hit = crosses(*[F.col(c) for c in ("x", "y", "x0", "y0", "x1", "y1")])
    e = e.select(*at, "id", "fid", to_segment(*[F.col(c) for c in SIDE]).alias("m"), hit.alias("hit"), (F.col("ring") == 0).alias("outer"))
    odd = lambda of: F.sum(F.when(of, F.col("hit")).otherwise(0)) % 2 == 1
    whole = e.groupBy(*at, "id", "fid").agg(F.min("m").alias("m"), (odd(F.col("outer")) & ~odd(~F.col("outer"))).alias("inside"))
    return whole.select("id", "fid", F.when(F.col("inside"), 0.0).otherwise(F.col("m")).alias("m")).where(F.col("m") <= reach_m)


def _measured(met: DataFrame, reach_m: float) -> DataFrame:
    """(id, fid, m) of points (id, x, y, sx) that met areas (fid, min_x, min_y, max_x, max_y, rings), where they are within reach."""
    x, y, sx = F.col("x"), F.col("y"), F.col("sx")
    inside = x.between(F.col("min_x"), F.col("max_x")) & y.between(F.col("min_y"), F.col("max_y")) & _holds(F.col("rings"), x, y)
    edge = F.array_min(F.transform("rings", lambda r: F.array_min(to_segments(x, y, r["e"], sx))))
    # behind a generator, as a filter on m itself would work it out twice
    m = F.explode_outer(F.array(F.when(inside, F.lit(0.0)).otherwise(edge))).alias("m")
    return met.where(_in_box(reach_m)).select("id", "fid", m).where(F.col("m") <= reach_m)


#: Cells of areas that are looked up whole are no higher than this, in degrees, and lie within these bounds: no row of theirs comes near a pole or the 180th meridian.
WHOLE_HIGH, WHOLE_X, WHOLE_Y = 1.0, 170.0, 80.0


def _whole_boxes(segments: DataFrame, reach_m: float) -> DataFrame:
    """(fid, min_x, min_y, max_x, max_y, edges, level, whole): bounds of areas, and whether one is looked up whole."""
    boxes = _area_boxes(segments)
    fit = (F.col("edges") <= FEW_EDGES) & (F.col("min_x") >= -WHOLE_X) & (F.col("max_x") <= WHOLE_X) & (F.col("min_y") >= -WHOLE_Y) & (F.col("max_y") <= WHOLE_Y) & (_high(reach_m, F.col("level")) <= WHOLE_HIGH)
    return cut(leveled(boxes, reach_m).withColumn("whole", F.coalesce(fit, F.lit(False))))


def within_polygons(points: DataFrame, segments: DataFrame, reach_m: float, same: tuple[str, ...] = ()) -> DataFrame:
    """(id, fid, m): points and areas within reach, 0 metres for points inside. segments: fid, ring, x0, y0, x1, y1. Ids of points are different. With same, only those that agree in these columns of both, which are no nulls."""
    names = segments.select("fid", *same).distinct()
    segments = segments.select("fid", "ring", "x0", "y0", "x1", "y1")
    boxes = _whole_boxes(segments, reach_m)
    whole = boxes.where("whole").drop("whole")
    near = _near_whole(points, whole.join(names, "fid") if same else whole, segments.join(whole.select("fid"), "fid", "left_semi"), reach_m, same)
    rest = boxes.where("not whole").select("fid")
    if rest.isEmpty():
        return near
    other = _near_parts(points, segments.join(rest, "fid", "left_semi"), reach_m)
    if same:
        other = other.join(points.select("id", *same), "id").join(names, ["fid", *same]).select("id", "fid", "m")
    return near.unionByName(other)


def within_own(points: DataFrame, segments: DataFrame, reach_m: float) -> DataFrame:
    """(id, fid, m): points (id, x, y, fid) within reach of the one area that each names, as within_polygons() has them, without the pairs of points and other areas."""
    from .graph import spread_join

    segments = segments.select("fid", "ring", "x0", "y0", "x1", "y1")
    boxes = _whole_boxes(segments, reach_m)
    whole = boxes.where("whole").select("fid", "min_x", "min_y", "max_x", "max_y")
    spots = points.select("id", "x", "y", "fid").withColumn("sx", scale_x(F.col("y")))
    near = _measured(spread_join(spots, whole.join(_rings_in_rows(segments), "fid"), "fid"), reach_m)
    rest = boxes.where("not whole").select("fid")
    if rest.isEmpty():
        return near
    own = points.select("id", "x", "y", "fid").join(rest, "fid", "left_semi")
    return near.unionByName(_near_parts(own, segments.join(rest, "fid", "left_semi"), reach_m).join(own.select("id", "fid"), ["id", "fid"], "left_semi"))


def _near_parts(points: DataFrame, segments: DataFrame, reach_m: float) -> DataFrame:
    """within_polygons() for areas of any form, edge by edge."""
    args = [F.col(c) for c in SIDE]
    edge = near_segments(points.select("id", "x", "y"), segments.select("fid", "x0", "y0", "x1", "y1"), reach_m).select("id", "fid", to_segment(*args).alias("m")).where(F.col("m") <= reach_m)
    inside = contained(points, segments, reach_m).withColumn("m", F.lit(0.0))
    return edge.unionByName(inside).groupBy("id", "fid").agg(F.min("m").alias("m"))


#: Places that a cell of the first search for nearest ones holds on the average, as its places see it, and the least reach that it begins with, in metres.
FEW_PLACES, LEAST_M = 4.0, 1.0
#: Points that are few enough to be taken to what they look for.
FEW_POINTS = 10_000


def first_reach(places: DataFrame, reach_m: float) -> float:
    """Where a search for the nearest of places (x, y) begins: at reach_m, or below where they lie dense, so that a point meets a few of them however many there are."""
    rows = places.select("x", "y")
    while True:
        held = point_cells(rows, reach_m).groupBy("cx", "cy").agg(F.count(F.lit(1)).cast("double").alias("n")).agg(F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum("n").alias("n")).first()
        if not held["n"] or reach_m <= LEAST_M or held["nn"] / held["n"] <= FEW_PLACES:
            return reach_m
        reach_m = max(min(LEAST_M, reach_m), reach_m / 2 ** math.ceil(math.log(held["nn"] / held["n"] / FEW_PLACES, 4)))


def _doubling(points: DataFrame, reach_m: float, look, most_m: float = FARTHEST_M, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """What look(points, reach, few) finds for each id (or keys), with the reach doubled for those that found nothing (four times as far if they are few), until all have or most_m is reached."""
    left, out, reach = cut(points), None, min(reach_m, most_m)
    few = left.count() <= FEW_POINTS
    while True:
        best = cut(look(left, reach, few))
        out = best if out is None else out.unionByName(best)
        if reach >= most_m:
            return out
        left = cut(left.join(best.select(*keys), list(keys), "left_anti"))
        n = left.count()
        if not n:
            return out
        reach, few = min(reach * (4 if few else 2), most_m), n <= FEW_POINTS


def nearest_area(points: DataFrame, segments: DataFrame, reach_m: float) -> DataFrame:
    """(id, fid, m): of the areas that within_polygons() has for each point (id, x, y) the nearest one, ties to the lower fid.

    The search begins where a point meets few areas, so dense places don't bring all pairs within reach.
    """
    held = stored(segments.select("fid", "ring", "x0", "y0", "x1", "y1"), "edges")

    def look(left: DataFrame, reach: float, few: bool) -> DataFrame:
        near = within_polygons(left, held, reach)
        return near.groupBy("id").agg(F.min(F.struct("m", "fid")).alias("t")).select("id", "t.fid", "t.m")

    corners = held.groupBy("fid").agg(F.min("x0").alias("x"), F.min("y0").alias("y"))
    return _doubling(points.select("id", "x", "y"), first_reach(corners, reach_m), look, reach_m)


def nearest_point(points: DataFrame, targets: DataFrame, reach_m: float) -> DataFrame:
    """(id, target, m): each point's nearest target, however far; ties to the lower target id. Without targets there are no rows.

    Looks within reach, or less where targets lie dense, then doubles it for the
    points that found none. What is found within the reach of a round is nearest
    of all.
    """
    # of targets in one place the lowest counts
    held = cut(targets.groupBy("x", "y").agg(F.min("id").alias("target")))
    near = _point_boxes(held.select("target", F.col("x").alias("tx"), F.col("y").alias("ty")), "tx", "ty")

    def look(left: DataFrame, reach: float, few: bool) -> DataFrame:
        spots, cells = point_cells(left, reach), box_cells(near, reach)
        met = cells.join(F.broadcast(spots), ["cx", "cy"]) if few else dealt(spots, cells, ["cx", "cy"])
        met = met.withColumn("m", metres(F.col("x"), F.col("y"), F.col("tx") + F.col("shift"), F.col("ty"))).where(F.col("m") <= reach)
        return met.groupBy("id").agg(F.min(F.struct("m", "target")).alias("best")).select("id", F.col("best.target").alias("target"), F.col("best.m").alias("m"))

    if held.isEmpty():
        return look(points.select("id", "x", "y").limit(0), reach_m, False)
    return _doubling(points.select("id", "x", "y"), first_reach(held, reach_m), look)


def nearest_other(vertices: DataFrame, reach_m: float) -> DataFrame:
    """(id, m): metres from the vertices (id, x, y) of each shape, which are the centres, to the nearest vertex of another shape, however far. A shape that is alone has no row."""
    own = cut(vertices.select("id", "x", "y").distinct())
    # of the shapes with a vertex in one place the first and the last are enough to have another one
    places = cut(own.groupBy("x", "y").agg(F.min("id").alias("lo"), F.max("id").alias("hi")))
    if places.agg(F.min("lo").eqNullSafe(F.max("hi"))).first()[0]:
        return own.select("id", F.lit(0.0).alias("m")).limit(0)
    near = _point_boxes(places.select("lo", "hi", F.col("x").alias("tx"), F.col("y").alias("ty")), "tx", "ty")

    def look(left: DataFrame, reach: float, few: bool) -> DataFrame:
        spots, cells = point_cells(own.join(left, "id", "left_semi"), reach), box_cells(near, reach)
        met = cells.join(F.broadcast(spots), ["cx", "cy"]) if few else dealt(spots, cells, ["cx", "cy"])
        met = met.where("id <> lo or id <> hi").select("id", metres(F.col("x"), F.col("y"), F.col("tx") + F.col("shift"), F.col("ty")).alias("m"))
        return met.where(F.col("m") <= reach).groupBy("id").agg(F.min("m").alias("m"))

    return _doubling(own.select("id").distinct(), first_reach(places, reach_m), look)


def snapped(points: DataFrame, segments: DataFrame, reach_m: float, few: bool = False) -> DataFrame:
    """(id, m, x, y): points within reach of a segment (x0, y0, x1, y1), the metres to the nearest one and the place on it; ties to the place further west, then south."""
    args = [F.col(c) for c in SIDE]
    met = near_segments(points.select("id", "x", "y"), segments.select("x0", "y0", "x1", "y1"), reach_m, few=few).select("id", nearest_on(*args).alias("at"))
    met = met.withColumn("at", F.struct("at.m", F.when(F.col("at.x") > 180.0, F.col("at.x") - 360.0).when(F.col("at.x") < -180.0, F.col("at.x") + 360.0).otherwise(F.col("at.x")).alias("x"), "at.y"))
    return met.where(F.col("at.m") <= reach_m).groupBy("id").agg(F.min("at").alias("at")).select("id", "at.m", "at.x", "at.y")


def _starts(segments: DataFrame) -> DataFrame:
    return segments.select(F.col("x0").alias("x"), F.col("y0").alias("y")).distinct()


def held_lines(segments: DataFrame, reach_m: float) -> tuple[DataFrame, float]:
    """segments stored, and where a search for the nearest of them begins: for several calls of snapped_within()."""
    held = stored(segments.select("x0", "y0", "x1", "y1"), "segments")
    return held, first_reach(_starts(held), reach_m)


def snapped_within(points: DataFrame, held: DataFrame, reach_m: float, most_m: float = FARTHEST_M) -> DataFrame:
    """(id, m, x, y): the nearest place on any segment for every point that has one within most_m; held and reach_m are those of held_lines()."""
    return _doubling(points.select("id", "x", "y"), reach_m, lambda left, reach, few: snapped(left, held, reach, few), most_m)


def snap_to_lines(points: DataFrame, segments: DataFrame, reach_m: float) -> DataFrame:
    """(id, m, x, y): the nearest place on any segment for every point, however far; `reach_m` is where the search begins, or below where segments lie dense. Without segments there are no rows."""
    held, first = held_lines(segments, reach_m)
    if held.isEmpty():
        return snapped(points.select("id", "x", "y").limit(0), held, reach_m)
    return snapped_within(points, held, first)


def sides_of(points: DataFrame | None = None, lines: DataFrame | None = None, areas: DataFrame | None = None) -> DataFrame:
    """Shapes of all kinds as one table: kind ("point", "line", "area"), sid, ring, x0, y0, x1, y1. points: id, x, y; lines: id, x0, y0, x1, y1 for each segment; areas: id, ring and the same."""
    point = None if points is None else points.select(F.lit("point").alias("kind"), F.col("id").alias("sid"), F.lit(None).cast("int").alias("ring"), F.col("x").alias("x0"), F.col("y").alias("y0"), F.col("x").alias("x1"), F.col("y").alias("y1"))
    line = None if lines is None else lines.select(F.lit("line").alias("kind"), F.col("id").alias("sid"), F.lit(None).cast("int").alias("ring"), "x0", "y0", "x1", "y1")
    area = None if areas is None else areas.select(F.lit("area").alias("kind"), F.col("id").alias("sid"), F.col("ring").cast("int").alias("ring"), "x0", "y0", "x1", "y1")
    given = [d for d in (point, line, area) if d is not None]
    out = given[0]
    for d in given[1:]:
        out = out.unionByName(d)
    return out


def _areas(sides: DataFrame) -> DataFrame:
    return sides.where("kind = 'area'").select(F.col("sid").alias("fid"), "ring", "x0", "y0", "x1", "y1")


def nearest_shapes(points: DataFrame, sides: DataFrame, kinds: list[str], reach_m: float) -> DataFrame:
    """(id, kind, sid, m): for each point (id, x, y) and each kind the nearest shape, however far: 0 inside an area, else to the nearest edge, line or point; ties to the lower sid. Infinity and no sid where no shape of the kind is. reach_m is where the search begins."""
    args = [F.col(c) for c in SIDE]
    best = lambda rows: rows.groupBy("id", "kind").agg(F.min(F.struct("m", "sid")).alias("t")).select("id", "kind", "t.sid", "t.m")
    held = stored(sides, "sides")
    there = {r["kind"] for r in held.select("kind").distinct().collect()} & set(kinds)
    every = cut(points.select("id", "x", "y"))
    out = every.select("id", F.explode(F.array(*[F.lit(k) for k in kinds])).alias("kind")).where(~F.col("kind").isin(sorted(there))).select("id", "kind", F.lit(None).cast(held.schema["sid"].dataType).alias("sid"), F.lit(float("inf")).alias("m"))
    if not there:
        return out
    of = {k: held.where(F.col("kind") == k).select("sid", "x0", "y0", "x1", "y1") for k in sorted(there)}
    left = every.withColumn("kind", F.explode(F.array(*[F.lit(k) for k in of])))
    if "area" in there:
        inside = cut(best(contained(every, _areas(held), reach_m).select("id", F.lit("area").alias("kind"), F.col("fid").alias("sid"), F.lit(0.0).alias("m"))))
        out, left = out.unionByName(inside), left.join(inside.select("id", "kind"), ["id", "kind"], "left_anti")
    first = {k: first_reach(_starts(own), reach_m) for k, own in of.items()}

    def look(rows: DataFrame, turn: float, few: bool) -> DataFrame:
        # each kind has a reach of its own; kinds that every point has found are left out of later rounds
        met = None
        for k in sorted(r["kind"] for r in rows.select("kind").distinct().collect()):
            reach = min(first[k] * turn, FARTHEST_M)
            near = near_segments(rows.where(F.col("kind") == k), of[k], reach, few=few).select("id", "kind", "sid", to_segment(*args).alias("m")).where(F.col("m") <= reach)
            met = near if met is None else met.unionByName(near)
        return best(rows.select("id", "kind", F.lit(None).cast(held.schema["sid"].dataType).alias("sid"), F.lit(0.0).alias("m")).limit(0) if met is None else met)

    return out.unionByName(_doubling(left, 1.0, look, FARTHEST_M / min(first.values()), ("id", "kind")))


def touching_shapes(sides: DataFrame, reach_m: float) -> DataFrame:
    """(a, b): pairs of shapes, a < b by (kind, sid), of which one has a vertex within reach of the other's edges, lines or points, or inside it. The vertex is the centre of the distance."""
    own = F.struct("kind", "sid")
    held = cut(sides)
    vertices = held.select(own.alias("id"), F.col("x0").alias("x"), F.col("y0").alias("y")).unionByName(held.select(own.alias("id"), F.col("x1").alias("x"), F.col("y1").alias("y"))).distinct()
    other = held.select(own.alias("other"), "x0", "y0", "x1", "y1")
    args = [F.col(c) for c in SIDE]
    met = near_segments(vertices, other, reach_m).where((F.col("id") != F.col("other")) & (to_segment(*args) <= reach_m)).select("id", "other")
    # every vertex is a point of its own in the search for what contains it
    marks = vertices.select(F.struct("id", "x", "y").alias("id"), "x", "y")
    inside = contained(marks, _areas(held), reach_m).select("id.id", F.struct(F.lit("area").alias("kind"), F.col("fid").alias("sid")).alias("other")).where(F.col("id") != F.col("other"))
    return met.unionByName(inside).select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def _looking(small: DataFrame, large: DataFrame, p: str, q: str, reach_m: float, same: tuple[str, ...], strict: bool) -> DataFrame:
    """Pairs of a small box (columns with prefix p) and one of its level or a higher one (prefix q); with strict only of a higher one."""
    high = _high(reach_m, F.col(f"{q}level"))
    # the small box is no larger than a cell of the level, so the large one comes within a cell of its corner
    around = large.withColumns({"min_x": F.col(f"{q}min_x"), "max_x": F.col(f"{q}max_x"), "max_y": F.col(f"{q}max_y"), "min_y": F.col(f"{q}min_y") - high, "level": F.col(f"{q}level")})
    cells = box_cells(around, reach_m).where(F.col("shift") == 0.0).drop("min_x", "max_x", "min_y", "max_y", "shift")
    corner = small.withColumns({"x": F.col(f"{p}min_x"), "y": F.col(f"{p}min_y")})
    found = point_cells(corner, reach_m, sorted(r[0] for r in large.select(f"{q}level").distinct().collect()))
    found = found.where(F.col(f"{p}level") < F.col("level") if strict else F.col(f"{p}level") <= F.col("level")).drop("x", "y")
    return dealt(found, cells, [*same, "level", "cx", "cy"]).drop("level", "cx", "cy")


def _level_of(boxes: DataFrame, p: str, reach_m: float) -> DataFrame:
    size = F.greatest((F.col(f"{p}max_x") - F.col(f"{p}min_x")) * LON_M * F.cos(F.radians(F.least(F.abs(f"{p}min_y"), F.abs(f"{p}max_y")))), (F.col(f"{p}max_y") - F.col(f"{p}min_y")) * LAT_M, F.lit(reach_m))
    return boxes.withColumn(f"{p}level", F.ceil(F.log2(size / reach_m)).cast("int"))


def meeting_boxes(left: DataFrame, right: DataFrame, reach_m: float, same: tuple[str, ...] = ()) -> DataFrame:
    """Rows of left (box min_x, min_y, max_x, max_y) and right (box o_min_x, ...) whose boxes are within reach, all columns of both; with same, only those that agree in these columns.

    Boxes are at the level of their size, and a pair meets on the level of the
    larger one, which is in all cells that it touches; the smaller one is
    where its corner is. Boxes must not reach across the 180th meridian.
    """
    pad_y = F.lit(reach_m / LAT_M)
    pad_x = F.least(pad_y * F.lit(LAT_M / LON_M) / F.cos(F.radians(F.least(F.greatest(F.abs("o_min_y"), F.abs("o_max_y")) + pad_y, F.lit(90.0)))), F.lit(360.0))
    wide = right.withColumns({"o_min_x": F.col("o_min_x") - pad_x, "o_max_x": F.col("o_max_x") + pad_x, "o_min_y": F.col("o_min_y") - pad_y, "o_max_y": F.col("o_max_y") + pad_y})
    a, b = cut(_level_of(left, "", reach_m).withColumnRenamed("level", "l_level").withColumnsRenamed({c: f"l_{c}" for c in ("min_x", "min_y", "max_x", "max_y")})), cut(_level_of(wide, "o_", reach_m))
    met = _looking(a, b, "l_", "o_", reach_m, same, False).unionByName(_looking(b, a, "o_", "l_", reach_m, same, True))
    met = met.where("l_min_x <= o_max_x and o_min_x <= l_max_x and l_min_y <= o_max_y and o_min_y <= l_max_y")
    return met.drop(*[f"{p}{c}" for p in ("l_", "o_") for c in ("min_x", "min_y", "max_x", "max_y", "level")])


def near_boxes(boxes: DataFrame, gap_x: float, gap_y: float, reach_m: float) -> DataFrame:
    """(a, b): pairs of boxes (id, min_x, min_y, max_x, max_y), a < b, no further apart than the gaps (degrees). reach_m: about how large a small box is. Ids are different.

    A pair that meets twice, each as the smaller one, is taken once, so pairs are not shuffled again.
    """
    names = ["min_x", "min_y", "max_x", "max_y"]
    wide = [(F.col(c) + (s * (gap_x if c.endswith("x") else gap_y))).alias(f"w_{c}") for c, s in zip(names, (-1, -1, 1, 1), strict=True)]
    rows = _level_of(_level_of(boxes.select("id", *names, *wide), "", reach_m), "w_", reach_m)
    held = cut(rows.select("id", *names, *[f"w_{c}" for c in names], F.col("level"), F.col("w_level")))
    a = held.select(*[F.col(c).alias(f"l_{c}") for c in held.columns])
    b = held.select(F.col("id").alias("o_id"), *[F.col(f"w_{c}").alias(f"o_{c}") for c in (*names, "level")], *[F.col(c).alias(f"o_own_{c}") for c in (*names, "level")])
    met = _looking(a, b, "l_", "o_", reach_m, (), False)
    back = "o_own_level <= l_w_level"
    met = met.where(f"l_id < o_id or (l_id > o_id and not ({back}))")
    forth = "l_min_x <= o_max_x and o_min_x <= l_max_x and l_min_y <= o_max_y and o_min_y <= l_max_y"
    other = "o_own_min_x <= l_w_max_x and l_w_min_x <= o_own_max_x and o_own_min_y <= l_w_max_y and l_w_min_y <= o_own_max_y"
    return met.where(f"({forth}) or ({back} and {other})").select(F.least("l_id", "o_id").alias("a"), F.greatest("l_id", "o_id").alias("b"))
