"""Networks: edges from lines, components, bounded shortest paths, fitting."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import metres
from ..storage import cut, stored
from .measures import segments


def line_graph(vertices: DataFrame, keys: list[str], places: int = 7) -> DataFrame:
    """Undirected edges (ax, ay, bx, by) between consecutive vertices, ends rounded, each once; no edge to itself."""
    s = segments(vertices, keys).select(*[F.bround(c, places).alias(c) for c in ("x0", "y0", "x1", "y1")])
    a, b = F.struct(F.col("x0").alias("x"), F.col("y0").alias("y")), F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"))
    ends = s.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct()
    return ends.select(F.col("a.x").alias("ax"), F.col("a.y").alias("ay"), F.col("b.x").alias("bx"), F.col("b.y").alias("by"))


def canonical_edges(edges: DataFrame) -> DataFrame:
    """(a, b, type) with a < b; of several the first by (pos, type) gives the type; loops and edges with a null end are dropped."""
    lo, hi = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    return edges.where("a <> b").select(lo, hi, "type", "pos").groupBy("a", "b").agg(F.min(F.struct("pos", "type")).alias("t")).select("a", "b", F.col("t.type").alias("type"))


def spread_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """left joined with right on `key`, where a key may hold a large share of the rows of left and right has one row for each.

    A join behind an aggregation takes over its partitions, which Spark can't
    split. Joined on the key and a hash of it, both sides are dealt out for the
    join alone, and the adaptive skew join splits what is too large.
    """
    dealt = "dealt_by_hash"
    return left.withColumn(dealt, F.xxhash64(key)).join(right.withColumn(dealt, F.xxhash64(key)), [key, dealt], how).drop(dealt)


#: Edges that a task of a round of components takes, and the least number of tasks.
EDGES_A_TASK, LEAST_TASKS = 100_000, 8


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root): for each node of an edge (columns a, b) the smallest node that it is connected with.

    Alternates two steps until nothing changes: larger neighbours are tied to a
    node's smallest neighbour, then smaller ones to the smallest. A round takes
    minima and joins; no node's neighbours are gathered, and the edges of a hub
    are split among tasks. A round takes as many tasks as its edges ask for, so
    that a small network leaves no swarm of tiny shuffle files behind. Edges to
    itself and edges with a null end are ignored.
    """
    state = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    for _ in range(rounds):
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
        tasks = max(LEAST_TASKS, now[0] // EDGES_A_TASK)
        state = state.coalesce(tasks)
        both = state.unionAll(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(tasks)
        large = spread_join(both.where("v > u"), least, "u").coalesce(tasks).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct().coalesce(tasks)
        least = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
        small = spread_join(large, least, "u").coalesce(tasks).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        state = cut(small.unionAll(least.select("u", F.col("m").alias("v"))).coalesce(tasks).distinct().coalesce(tasks))
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def shortest_paths(edges: DataFrame, starts: DataFrame, limit: float, rounds: int = 200) -> DataFrame:
    """(start, node, cost, prev): cheapest ways of at most `limit` from each start, along undirected edges (a, b, cost > 0).

    Only nodes whose cost fell in a round are sent on in the next. Of equally
    cheap ways the one by the smaller node counts.
    """
    both = cut(edges.select("a", "b", "cost").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "cost")))
    known = cut(starts.select(F.col("node").alias("start"), "node", F.lit(0.0).alias("cost"), F.lit(None).cast("long").alias("prev")))
    front = known
    for _ in range(rounds):
        sent = front.join(both.withColumnRenamed("cost", "w"), F.col("node") == F.col("a")).select("start", F.col("b").alias("node"), (F.col("cost") + F.col("w")).alias("cost"), F.col("node").alias("prev")).where(F.col("cost") <= limit)
        best = known.unionByName(sent).groupBy("start", "node").agg(F.min(F.struct("cost", "prev")).alias("x")).select("start", "node", "x.cost", "x.prev")
        best = cut(best)
        old = known.select("start", "node", F.col("cost").alias("was"))
        front = cut(best.join(old, ["start", "node"], "left").where("was is null or cost < was").select("start", "node", "cost", "prev"))
        known = best
        if front.isEmpty():
            return known
    raise RuntimeError(f"paths did not settle in {rounds} rounds")


def affine_sums(pairs: DataFrame):
    """The twelve sums of a least-squares affine fit (px, py) -> (x, y), as one row."""
    px, py, x, y = (F.col(c) for c in ("px", "py", "x", "y"))
    parts = {"n": F.lit(1.0), "p": px, "q": py, "pp": px * px, "pq": px * py, "qq": py * py, "x": x, "px": px * x, "qx": py * x, "y": y, "py": px * y, "qy": py * y}
    return pairs.agg(*[F.sum(v).alias(f"s_{k}") for k, v in parts.items()])


def affine_fit(pairs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients (a, b, c) of x = a*px + b*py + c and of y likewise; twelve sums come to the driver."""
    s = affine_sums(pairs).first().asDict()
    m = np.array([[s["s_pp"], s["s_pq"], s["s_p"]], [s["s_pq"], s["s_qq"], s["s_q"]], [s["s_p"], s["s_q"], s["s_n"]]])
    return np.linalg.solve(m, [s["s_px"], s["s_qx"], s["s_x"]]), np.linalg.solve(m, [s["s_py"], s["s_qy"], s["s_y"]])


def mapped(nodes: DataFrame, fit: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """nodes (id, px, py) with x and y under an affine map."""
    at = lambda k: F.col("px") * float(k[0]) + F.col("py") * float(k[1]) + float(k[2])
    return nodes.withColumns({"x": at(fit[0]), "y": at(fit[1])})


def icp(nodes: DataFrame, anchors: DataFrame, segments: DataFrame, far_m: float = 40.0, least: int = 12, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """The affine map that lays nodes (id, px, py) on lines (segments x0, y0, x1, y1).

    It begins with the map of the anchors (px, py, x, y), whose places are
    known. In each round every node meets the nearest place on a line, if that
    is less than far_m away, and the map is fit anew to these and the anchors; it
    ends after `rounds`, or where fewer than `least` nodes meet a line.
    """
    from .grid import held_lines, snapped_within

    fit = affine_fit(anchors)
    lines, reach = held_lines(segments, far_m)
    known = anchors.select("px", "py", "x", "y")
    for _ in range(rounds):
        near = snapped_within(mapped(nodes, fit), lines, reach, far_m).where(F.col("m") < far_m)
        pairs = cut(nodes.join(near, "id").select("px", "py", "x", "y"))
        if pairs.count() < least:
            break
        fit = affine_fit(pairs.unionByName(known))
    return fit


def _relabelled(held: DataFrame, ties: DataFrame) -> DataFrame:
    """held (id, label, ...) with the labels that ties (a, b) bring together made one."""
    roots = components(ties).withColumnRenamed("node", "label")
    return spread_join(held, roots, "label", "left").withColumn("label", F.coalesce("root", "label")).drop("root")


def linked_lines(vertices: DataFrame, reach_m: float) -> DataFrame:
    """(id, label): the lines (trail, line as id) with what they are linked to, by lines of their trail that a vertex of one lies within reach of; vertices: trail, line, seq, x, y.

    Lines with a vertex in one small cell are tied to its first line, the first
    ones of cells to each other. Vertices and segments are compared only between
    a trail's largest set and what is not in it yet, or among the latter, so
    dense trails bring few pairs.
    """
    from .grid import SIDE, _point_boxes, box_cells, dealt, near_few_segments, near_segments, point_cells, to_segment

    v = stored(vertices.select("trail", F.struct("trail", "line").alias("id"), "line", "seq", "x", "y"), "vertices")
    sides = segments(v, ["trail", "id"]).select("trail", "id", "x0", "y0", "x1", "y1")
    lines = cut(v.groupBy("trail", "id").agg(F.count(F.lit(1)).alias("n")).select("trail", "id", F.col("id").alias("label"), (F.col("n") > 1).alias("long")))
    # a line of one vertex has no segment that others could be near to
    long = v.join(lines.where("long").select("id"), "id", "left_semi")
    cells = point_cells(long.select("trail", "id", "x", "y"), reach_m / 2)
    first = cut(cells.groupBy("trail", "cx", "cy").agg(F.min(F.struct("id", "x", "y")).alias("r")))
    near = metres(F.col("x"), F.col("y"), F.col("r.x"), F.col("r.y")) <= reach_m
    ties = cells.join(first, ["trail", "cx", "cy"]).where(near).select(F.col("id").alias("a"), F.col("r.id").alias("b")).where("a <> b").distinct()
    lines = cut(_relabelled(lines, ties))
    heads = cut(first.select(F.col("trail"), F.col("r.id").alias("id"), F.col("r.x").alias("x"), F.col("r.y").alias("y")).join(lines.select("id", "label"), "id").drop("id"))
    other = _point_boxes(heads.select("trail", F.col("label").alias("other"), F.col("x").alias("bx"), F.col("y").alias("by")), "bx", "by")
    met = dealt(point_cells(heads, reach_m), box_cells(other, reach_m), ["trail", "cx", "cy"]).where("label < other")
    met = met.where(metres(F.col("x"), F.col("y"), F.col("bx") + F.col("shift"), F.col("by")) <= reach_m)
    lines = cut(_relabelled(lines, met.select(F.col("label").alias("a"), F.col("other").alias("b")).distinct()))
    largest = lines.where("long").groupBy("trail", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("trail").agg(F.max_by("label", F.struct("n", "label")).alias("main"))
    lines = cut(lines.join(largest, "trail", "left").withColumn("apart", ~F.col("label").eqNullSafe(F.col("main"))).drop("main"))
    # two different sets are never both the largest one
    told = lines.select("id", "label", "apart")
    spots = v.select("trail", "id", "x", "y").join(told, "id").drop("id")
    edges = sides.join(told.withColumnsRenamed({"label": "other", "apart": "off"}), "id").drop("id")
    to = to_segment(*[F.col(c) for c in SIDE]) <= reach_m
    pairs = near_segments(spots.where("apart").drop("apart"), edges.drop("off"), reach_m, ("trail",)).where("label <> other").where(to).select("label", "other")
    pairs = pairs.unionByName(near_few_segments(spots.where("not apart").drop("apart"), edges.where("off").drop("off"), reach_m, ("trail",)).where("label <> other").where(to).select("label", "other"))
    return _relabelled(lines.select("id", "label"), pairs.select(F.col("label").alias("a"), F.col("other").alias("b")).distinct())


def assembled(vertices: DataFrame, reach_m: float) -> DataFrame:
    """(trail, pieces, parts, metres, vertices): lines put together to trails. vertices: trail, line, seq, x, y.

    Two lines of a trail join where a vertex of one lies within reach of the
    other, at an end or along it. parts is how many separate pieces are left: a
    trail that is whole has one.
    """
    from .measures import lengths

    roots = linked_lines(vertices, reach_m).select(F.col("id.trail").alias("trail"), F.col("id.line").alias("line"), F.col("label.line").alias("part"))
    lines = vertices.groupBy("trail", "line").agg(F.count(F.lit(1)).alias("n")).join(lengths(vertices, ["trail", "line"]), ["trail", "line"], "left")
    tied = lines.join(roots, ["trail", "line"], "left").withColumn("part", F.coalesce("part", "line"))
    return tied.groupBy("trail").agg(F.count(F.lit(1)).alias("pieces"), F.count_distinct("part").alias("parts"), F.coalesce(F.sum("metres"), F.lit(0.0)).alias("metres"), F.sum("n").alias("vertices"))


def untidy(trails: DataFrame, lengths_m: DataFrame, tolerance_m: float = 80.4672) -> DataFrame:
    """(check_name, key): trails in several parts, and those whose length is not the given one (trail, wanted_m) within the tolerance (0.05 mi)."""
    from .checks import violations

    off = trails.join(lengths_m, "trail").where(F.abs(F.col("metres") - F.col("wanted_m")) > tolerance_m)
    return violations({"in several parts": trails.where("parts > 1"), "wrong length": off}, "trail")


def cut_at(vertices: DataFrame, cuts: DataFrame, reach_m: float = 5.0) -> DataFrame:
    """vertices (line, seq, x, y) on one side of the vertex nearest to a given place, which both sides keep.

    cuts: line, x, y, side ("before" or "after"). Ties go to the lower seq; a
    line without a cut stays whole; a cut further than reach_m from every vertex
    is an error, as it was made for another line.
    """
    from .grid import metres

    at = cuts.select("line", F.col("x").alias("cut_x"), F.col("y").alias("cut_y"), "side")
    near = vertices.join(at, "line").groupBy("line", "side").agg(F.min(F.struct(metres(F.col("cut_x"), F.col("cut_y"), F.col("x"), F.col("y")).alias("m"), "seq")).alias("t"))
    seq = F.when(F.col("t.m") <= reach_m, F.col("t.seq")).otherwise(F.raise_error(F.format_string("line %s has no vertex near its cut", F.col("line").cast("string"))).cast("int"))
    kept = vertices.join(near.select("line", "side", seq.alias("cut")), "line", "left")
    return kept.where("side is null or (side = 'before' and seq <= cut) or (side = 'after' and seq >= cut)").select(*vertices.columns)


def part_rows(vertices: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, seq, x, y): parts of many-part lines (trail, part, seq, x, y) as lines of their own. wanted: trail, part, id."""
    return vertices.join(wanted.select("trail", "part", "id"), ["trail", "part"]).select("id", "seq", "x", "y")


def merged_lines(vertices: DataFrame, kinds: DataFrame) -> DataFrame:
    """(kind, part, seq, x, y): one many-part line for each kind, its lines (kind, line) as parts from 0, by their ids. A kind may hold any number of lines, so it stays in rows."""
    from .ranks import ranked

    numbers = ranked(kinds.select("kind", "line").distinct(), ["kind", "line"])
    first = numbers.groupBy("kind").agg(F.min("rank").alias("first"))
    parts = spread_join(numbers, first, "kind").select("kind", "line", (F.col("rank") - F.col("first")).alias("part"))
    return vertices.join(parts, "line").select("kind", F.col("part").cast("long").alias("part"), "seq", "x", "y")
