"""Measures of shapes given as vertex rows: (fid, part, ring, seq, x, y); missing grouping columns are those of the caller's keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import crosses, haversine, metres, scale_x, to_segment, to_segments, with_rounded
from ..storage import cut


def segments(vertices: DataFrame, keys: list[str], carry: tuple[str, ...] = ()) -> DataFrame:
    """Consecutive pairs of vertices: keys, seq, x0, y0, x1, y1."""
    w = Window.partitionBy(*keys).orderBy("seq")
    return vertices.select(*keys, *carry, "seq", F.col("x").alias("x0"), F.col("y").alias("y0"), F.lead("x").over(w).alias("x1"), F.lead("y").over(w).alias("y1")).where("x1 is not null")


def bounds(vertices: DataFrame, keys: list[str]) -> DataFrame:
    return vertices.groupBy(*keys).agg(F.min("x").alias("min_x"), F.min("y").alias("min_y"), F.max("x").alias("max_x"), F.max("y").alias("max_y"))


def frames(vertices: DataFrame, keys: list[str], pad: float, least: float) -> DataFrame:
    """Bounds widened by `pad`, at least `least` wide and no taller than wide."""
    b = bounds(vertices, keys)
    mid_x, mid_y = (F.col("min_x") + F.col("max_x")) / 2, (F.col("min_y") + F.col("max_y")) / 2
    tall = F.col("max_y") - F.col("min_y") + 2 * pad
    wide = F.greatest(F.col("max_x") - F.col("min_x") + 2 * pad, F.lit(least), tall)
    return b.select(*keys, mid_x.alias("mid_x"), mid_y.alias("mid_y"), wide.alias("width"), tall.alias("height"))


def ring_areas(vertices: DataFrame, keys: list[str]) -> DataFrame:
    """Signed area of each ring (square degrees) and its centroid; a ring without area has the mean of its vertices but the last."""
    cross = F.col("x0") * F.col("y1") - F.col("x1") * F.col("y0")
    s = segments(vertices, keys)
    sums = s.groupBy(*keys).agg((F.sum(cross) / 2).alias("area"), F.sum((F.col("x0") + F.col("x1")) * cross).alias("sx"), F.sum((F.col("y0") + F.col("y1")) * cross).alias("sy"), F.avg("x0").alias("mx"), F.avg("y0").alias("my"))
    flat = F.abs("area") < 1e-15
    safe = F.when(flat, 1.0).otherwise(F.col("area"))
    return sums.select(*keys, F.when(flat, 0.0).otherwise(F.col("area")).alias("area"), F.when(flat, F.col("mx")).otherwise(F.col("sx") / (6 * safe)).alias("cx"), F.when(flat, F.col("my")).otherwise(F.col("sy") / (6 * safe)).alias("cy"))


def lengths(vertices: DataFrame, keys: list[str]) -> DataFrame:
    """Metres along each line."""
    return segments(vertices, keys).groupBy(*keys).agg(F.sum(haversine(*[F.col(c) for c in ("x0", "y0", "x1", "y1")])).alias("metres"))


def _steps() -> Column:
    """Samples of a segment: about one a metre, at least one."""
    return F.greatest(F.lit(1), F.ceil(metres(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))).cast("int"))


def _sampled(segs: DataFrame) -> DataFrame:
    """segs (seq, x0, y0, x1, y1, n) once for each sample, with step, x, y: vertices included, each once, rounded to 7 places."""
    rows = segs.withColumn("step", F.explode(F.when(F.col("seq") == 0, F.sequence(F.lit(0), F.col("n"))).otherwise(F.sequence(F.lit(1), F.col("n")))))
    at = F.col("step") / F.col("n")
    return with_rounded(rows, {"x": F.col("x0") + (F.col("x1") - F.col("x0")) * at, "y": F.col("y0") + (F.col("y1") - F.col("y0")) * at})


def densified(vertices: DataFrame, keys: list[str]) -> DataFrame:
    """Points about a metre apart along each line (seq from 0), vertices included: keys, seq, step (0: the first vertex), x, y, rounded to 7 places."""
    return _sampled(segments(vertices, keys).withColumn("n", _steps())).select(*keys, "seq", "step", "x", "y")


#: Segments of the other shape up to which they are held in one row.
FEW_SIDES = 64


def _sure(reach_m: float) -> tuple[float, Column]:
    """Metres from one segment within which both ends of another have to be for all of it to be near, and whether it is fit to be told by its ends."""
    # well inside the reach, as scale and rounding differ a little along a segment
    return reach_m * 0.94 - 0.02, (F.abs(F.col("y1") - F.col("y0")) < 0.5) & (F.greatest(F.abs("y0"), F.abs("y1")) < 80)


def _off_few(own: DataFrame, other: DataFrame, keys: list[str], reach_m: float) -> DataFrame:
    """(keys, at, x, y): samples of own that are off, where the other shape has few segments: they are one row, so a line is together after one shuffle and nothing else is written."""
    sides = other.groupBy(*keys).agg(F.collect_list(F.struct("x0", "y0", "x1", "y1")).alias("sides"))
    # rows are small and their samples many: in a fixed number of parts they are not gathered into one task
    sides = sides.repartition(int(own.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    sure, flat = _sure(reach_m)
    ends = F.zip_with(to_segments(F.col("x0"), F.col("y0"), F.col("sides"), F.col("sx0")), to_segments(F.col("x1"), F.col("y1"), F.col("sides"), F.col("sx1")), lambda a, b: F.greatest(a, b))
    rest = own.join(sides, keys, "left").where(~F.coalesce(flat & (F.array_min(ends) <= sure), F.lit(False)))
    samples = _sampled(rest.drop("sx0", "sx1")).withColumn("sx", scale_x(F.col("y")))
    samples = samples.select(*keys, (F.col("before") + F.col("step")).alias("at"), "x", "y", "sx", F.explode_outer("sides").alias("s"))
    samples = samples.select(*keys, "at", "x", "y", to_segment(F.col("x"), F.col("y"), *[F.col(f"s.{c}") for c in ("x0", "y0", "x1", "y1")], F.col("sx")).alias("m"))
    return _far(samples, keys, reach_m)


def _far(samples: DataFrame, keys: list[str], reach_m: float) -> DataFrame:
    """Samples (keys, at, x, y, m: metres to one segment each) that no segment is near."""
    off = samples.groupBy(*keys, "at").agg(F.min("m").alias("m"), F.first("x").alias("x"), F.first("y").alias("y"))
    return off.where(F.col("m").isNull() | (F.col("m") > reach_m)).select(*keys, "at", "x", "y")


def _off_many(own: DataFrame, other: DataFrame, keys: list[str], reach_m: float) -> DataFrame:
    """_off_few() for shapes of any number of segments, by the grid."""
    from .grid import meeting_boxes

    own = cut(own)
    box = lambda df, p: df.withColumns({f"{p}min_x": F.least(f"{p}x0", f"{p}x1"), f"{p}max_x": F.greatest(f"{p}x0", f"{p}x1"), f"{p}min_y": F.least(f"{p}y0", f"{p}y1"), f"{p}max_y": F.greatest(f"{p}y0", f"{p}y1")})
    sides = other.select(*keys, *[F.col(c).alias(f"o_{c}") for c in ("x0", "y0", "x1", "y1")])
    met = meeting_boxes(box(own, ""), box(sides, "o_"), reach_m, tuple(keys)).select(*keys, "seq", "x0", "y0", "x1", "y1", "sx0", "sx1", *sides.columns[len(keys) :])
    target = [F.col(f"o_{c}") for c in ("x0", "y0", "x1", "y1")]
    sure, flat = _sure(reach_m)
    met = met.withColumns({"first_m": to_segment(F.col("x0"), F.col("y0"), *target, F.col("sx0")), "last_m": to_segment(F.col("x1"), F.col("y1"), *target, F.col("sx1"))})
    met = cut(met.withColumn("whole", flat & (F.col("first_m") <= sure) & (F.col("last_m") <= sure)).drop("first_m", "last_m"))
    rest = own.join(met.where("whole").select(*keys, "seq").distinct(), [*keys, "seq"], "left_anti")
    tried = rest.join(met.where("not whole").select(*keys, "seq", *sides.columns[len(keys) :]), [*keys, "seq"], "left")
    samples = _sampled(tried.drop("sx0", "sx1")).withColumns({"at": F.col("before") + F.col("step"), "sx": scale_x(F.col("y"))})
    samples = samples.select(*keys, "at", "x", "y", to_segment(F.col("x"), F.col("y"), *target, F.col("sx")).alias("m"))
    return _far(samples, keys, reach_m)


def off_runs(vertices: DataFrame, other: DataFrame, keys: list[str], reach_m: float) -> DataFrame:
    """Runs of samples (a metre apart) of lines that lie further than `reach_m` from the other shape's segments: keys, run, points, metres. Lone samples are no run.

    vertices: keys, seq, x, y; other: keys, x0, y0, x1, y1. Samples without another shape are all off.
    A segment whose ends are near one segment of the other lies near it all
    along, so only the rest is sampled; the place of a sample in its line
    follows from the numbers of samples before.
    """
    line = Window.partitionBy(*keys).orderBy("seq")
    own = segments(vertices, keys).withColumn("n", _steps())
    # step 0 of the first segment is its place 0
    own = own.withColumns({"sx0": scale_x(F.col("y0")), "sx1": scale_x(F.col("y1")), "before": F.coalesce(F.sum("n").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    many = cut(other.groupBy(*keys).agg(F.count(F.lit(1)).alias("sides")).where(F.col("sides") > FEW_SIDES).select(*keys))
    if many.isEmpty():
        off = _off_few(own, other, keys, reach_m)
    else:
        off = _off_few(own.join(many, keys, "left_anti"), other.join(many, keys, "left_anti"), keys, reach_m).unionByName(_off_many(own.join(many, keys, "left_semi"), other.join(many, keys, "left_semi"), keys, reach_m))
    # gaps and islands: place among all samples less place among the off ones
    runs = off.withColumn("run", F.col("at") + 1 - F.row_number().over(Window.partitionBy(*keys).orderBy("at")))
    inside = Window.partitionBy(*keys, "run").orderBy("at")
    step = metres(F.lag("x").over(inside), F.lag("y").over(inside), F.col("x"), F.col("y"))
    return runs.withColumn("d", step).groupBy(*keys, "run").agg(F.count(F.lit(1)).alias("points"), F.sum("d").alias("metres")).where("points > 1")


def label_anchors(vertices: DataFrame) -> DataFrame:
    """(id, x, y): a place for the label of each area (vertices id, ring, seq, x, y): its centroid if that is inside, else the middle of the widest inner span on the centroid's row or, failing that, on ten others; the centroid if all fail."""
    segs = cut(segments(vertices, ["id", "ring"]))
    c = cut(ring_areas(vertices.where("ring = 0"), ["id", "ring"]).select("id", "cx", "cy"))
    ends = [F.col(k) for k in ("px", "py", "x0", "y0", "x1", "y1")]

    def inside(points):
        odd = points.join(segs, "id").groupBy("id", "row", "px", "py", "ring").agg((F.sum(crosses(*ends)) % 2).alias("odd"))
        return odd.groupBy("id", "row", "px", "py").agg((F.max(F.when(F.col("ring") == 0, F.col("odd")).otherwise(0)) == 1).alias("outer"), (F.max(F.when(F.col("ring") > 0, F.col("odd")).otherwise(0)) == 1).alias("hole")).where("outer and not hole")

    first = inside(c.select("id", F.lit(-1).alias("row"), F.col("cx").alias("px"), F.col("cy").alias("py"))).select("id", "row", "px", "py", F.lit(0.0).alias("width"))
    span = bounds(vertices.where("ring = 0"), ["id"]).join(c, "id")
    sweep = F.col("min_y") + (F.col("max_y") - F.col("min_y")) * (F.col("row") - 0.5) / 10
    rows = span.select("id", "cy", "min_y", "max_y", F.explode(F.sequence(F.lit(0), F.lit(10))).alias("row")).select("id", "row", F.when(F.col("row") == 0, F.col("cy")).otherwise(sweep).alias("py"))
    hit = (F.col("x0") + (F.col("py") - F.col("y0")) / (F.col("y1") - F.col("y0")) * (F.col("x1") - F.col("x0"))).alias("hit")
    hits = rows.join(segs, "id").where("(y0 > py) <> (y1 > py)").select("id", "row", "py", hit)
    gaps = hits.withColumn("next", F.lead("hit").over(Window.partitionBy("id", "row").orderBy("hit"))).where("next > hit")
    gaps = cut(gaps.select("id", "row", "py", ((F.col("hit") + F.col("next")) / 2).alias("px"), (F.col("next") - F.col("hit")).alias("width")))
    good = inside(gaps.select("id", "row", "px", "py")).join(gaps, ["id", "row", "px", "py"]).select("id", "row", "px", "py", "width")
    best = first.unionByName(good).groupBy("id").agg(F.min(F.struct("row", F.round(-F.col("width"), 9).alias("w"), "px", "py")).alias("t"))
    return c.join(best, "id", "left").select("id", F.coalesce("t.px", "cx").alias("x"), F.coalesce("t.py", "cy").alias("y"))


def anchors(vertices: DataFrame) -> DataFrame:
    """(id, x, y): a place for the label of each shape. vertices: id, kind ("point", "line", "area"), part, ring, seq (from 0), x, y.

    A point has its first position, a line its vertex n // 2 of n over all its
    parts, an area the place that label_anchors() finds in its largest part (of
    equal ones the first).
    """
    points = vertices.where("kind = 'point'").groupBy("id").agg(F.min(F.struct("part", "ring", "seq", "x", "y")).alias("t")).select("id", "t.x", "t.y")
    # which part holds the middle vertex follows from the numbers of vertices of the parts
    counts = vertices.where("kind = 'line'").groupBy("id", "part").agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("id")
    middle = counts.withColumns({"before": F.sum("n").over(own.orderBy("part")) - F.col("n"), "half": F.floor(F.sum("n").over(own) / 2)}).where("half >= before and half < before + n")
    lines = vertices.where("kind = 'line'").join(middle.select("id", "part", (F.col("half") - F.col("before")).alias("seq")), ["id", "part", "seq"]).select("id", "x", "y")
    areas = vertices.where("kind = 'area'")
    sizes = ring_areas(areas.where("ring = 0"), ["id", "part"]).groupBy("id").agg(F.max(F.struct(F.abs("area").alias("size"), (-F.col("part")).alias("turn"))).alias("t"))
    largest = areas.join(sizes.select("id", (-F.col("t.turn")).alias("part")), ["id", "part"], "left_semi")
    return points.unionByName(lines).unionByName(label_anchors(largest.select("id", "ring", "seq", "x", "y")))


def anchor_faults(found: DataFrame, vertices: DataFrame, stated: DataFrame, reach_m: float = 500.0) -> DataFrame:
    """(check_name, key): anchors (id, x, y) of areas that lie outside every part, anchors of lines that are none of their vertices (to 7 places), and stated lengths (id, length) that are not the line's in whole metres, 0 being no length."""
    from .checks import violations
    from .grid import contained

    found, vertices = cut(found), cut(vertices)
    has = lambda kind: vertices.where(F.col("kind") == kind).select("id").distinct()
    # every part is an area of its own, told from the others of the shape by its number
    parts = segments(vertices.where("kind = 'area'").select(F.struct("id", "part").alias("fid"), "ring", "seq", "x", "y"), ["fid", "ring"]).drop("seq")
    inside = contained(found.join(has("area"), "id", "left_semi"), parts, reach_m).where("id = fid.id").select("id").distinct()
    spots = lambda df: with_rounded(df.select("id", "x", "y"), {"x": F.col("x"), "y": F.col("y")})
    on_line = spots(found).join(spots(vertices.where("kind = 'line'")), ["id", "x", "y"], "left_semi")
    long = lengths(vertices.where("kind = 'line'"), ["id", "part"]).groupBy("id").agg(F.sum("metres").alias("metres"))
    long = stated.join(long, "id", "left").where(~F.col("length").cast("long").eqNullSafe(F.nullif(F.rint("metres").cast("long"), F.lit(0))))
    return violations(
        {
            "outside its area": found.join(has("area"), "id", "left_semi").join(inside, "id", "left_anti"),
            "not on its line": found.join(has("line"), "id", "left_semi").join(has("area"), "id", "left_anti").join(on_line, "id", "left_anti"),
            "not its line's length": long,
        },
        "id",
    )


def moved(before: DataFrame, after: DataFrame, keys: list[str], reach_m: float) -> DataFrame:
    """(keys, runs, dropped_m, added_m): stretches of the old line that lie off the new one, and of the new one off the old. Lines with neither have no row.

    before, after: keys, seq, x, y.
    """
    sides = {"dropped_m": (before, after), "added_m": (after, before)}
    rows = None
    for name, (own, other) in sides.items():
        runs = off_runs(own, segments(other, keys).drop("seq"), keys, reach_m)
        runs = runs.select(*keys, *[(F.col("metres") if n == name else F.lit(0.0)).alias(n) for n in sides])
        rows = runs if rows is None else rows.unionByName(runs)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("runs"), *[F.sum(n).alias(n) for n in sides])


#: Vertices of a line up to which it is simplified in one row.
FEW_VERTICES = 64


def _from_chord(v: Column, lo: Column, hi: Column) -> Column:
    """Distance of a vertex from the chord of its interval, in degrees."""
    dx, dy = hi["x"] - lo["x"], hi["y"] - lo["y"]
    long = dx * dx + dy * dy
    t = F.when(long == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((v["x"] - lo["x"]) * dx + (v["y"] - lo["y"]) * dy) / F.when(long == 0, 1.0).otherwise(long))))
    return F.hypot(v["x"] - lo["x"] - t * dx, v["y"] - lo["y"] - t * dy)


def _simplified_few(vertices: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """simplified() for lines of few vertices: a line is one row, so it is together after one shuffle and nothing else is written."""
    lines = vertices.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("seq", "x", "y"))).alias("p"))
    interval = lambda lo, hi: F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))
    wide = lambda open_: F.filter(open_, lambda i: i["hi"] - i["lo"] >= 2)
    once = lambda value, use: F.get(F.transform(F.array(value), use), 0)

    def step(state: Column, _: Column) -> Column:
        rest = F.slice(state["open"], 1, F.size(state["open"]) - 1)

        def split(i: Column) -> Column:
            lo, hi = F.get("p", i["lo"]), F.get("p", i["hi"])
            inner = F.transform(F.slice("p", i["lo"] + 2, i["hi"] - i["lo"] - 1), lambda v, k: F.struct(_from_chord(v, lo, hi).alias("d"), (-k).alias("turn")))
            # the farthest vertex splits an interval; ties go to the first
            return once(F.array_max(inner), lambda top: F.when(top["d"] > tolerance, halves(i, i["lo"] + 1 - top["turn"])).otherwise(F.struct(rest.alias("open"), state["kept"].alias("kept"))))

        def halves(i: Column, mid: Column) -> Column:
            return F.struct(F.concat(rest, wide(F.array(interval(i["lo"], mid), interval(mid, i["hi"])))).alias("open"), F.concat(state["kept"], F.array(mid)).alias("kept"))

        return F.when(F.size(state["open"]) == 0, state).otherwise(once(F.element_at(state["open"], -1), split))

    last = F.size("p") - 1
    start = F.struct(wide(F.array(interval(F.lit(0), last))).alias("open"), F.array(F.lit(0), last).alias("kept"))
    # every step settles a vertex at least
    turns = F.when(last >= 2, F.sequence(F.lit(1), last - 1)).otherwise(F.array().cast("array<int>"))
    kept = lines.withColumn("kept", F.aggregate(turns, start, step, lambda s: s["kept"]))
    return kept.select(*keys, F.inline(F.filter("p", lambda v, k: F.array_contains(F.col("kept"), k))))


def simplified(vertices: DataFrame, keys: list[str], tolerance: float, rounds: int = 10_000) -> DataFrame:
    """Vertices that stay when each line is simplified to `tolerance` (degrees). Lines of few vertices are done in one row, others in rounds."""
    base = vertices.select(*keys, "seq", "x", "y")
    many = cut(base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > FEW_VERTICES).select(*keys))
    if many.isEmpty():
        return _simplified_few(base, keys, tolerance)
    few = _simplified_few(base.join(many, keys, "left_anti"), keys, tolerance)
    return few.unionByName(_simplified_many(base.join(many, keys, "left_semi"), keys, tolerance, rounds))


def _simplified_many(vertices: DataFrame, keys: list[str], tolerance: float, rounds: int) -> DataFrame:
    """simplified() for lines of any length: all intervals of all lines are split together, round by round.

    Every vertex that is not decided yet carries the interval it lies in, so a
    round is one grouping and one join on intervals.
    """
    base = cut(vertices.select(*keys, "seq", "x", "y"))
    at = lambda f: f(F.struct("seq", "x", "y"))
    ends = base.groupBy(*keys).agg(at(F.min).alias("lo"), at(F.max).alias("hi"))
    kept = cut(ends.select(*keys, F.explode(F.array("lo.seq", "hi.seq")).alias("seq")).distinct())
    open_ = cut(base.join(ends, keys).where("seq > lo.seq and seq < hi.seq"))
    for _ in range(rounds):
        if open_.isEmpty():
            return base.join(kept, [*keys, "seq"], "left_semi")
        d = _from_chord({"x": F.col("x"), "y": F.col("y")}, F.col("lo"), F.col("hi"))
        # the farthest vertex splits an interval; ties go to the first
        far = open_.withColumn("d", d).groupBy(*keys, "lo", "hi").agg(F.max(F.struct("d", (-F.col("seq")).alias("turn"), "x", "y")).alias("top")).where(F.col("top.d") > tolerance)
        far = cut(far.select(*keys, "lo", "hi", F.struct((-F.col("top.turn")).cast(base.schema["seq"].dataType).alias("seq"), F.col("top.x").alias("x"), F.col("top.y").alias("y")).alias("mid")))
        kept = cut(kept.unionByName(far.select(*keys, F.col("mid.seq").alias("seq"))))
        rest = open_.join(far, [*keys, "lo", "hi"]).where("seq <> mid.seq")
        before = F.col("seq") < F.col("mid.seq")
        open_ = cut(rest.select(*keys, "seq", "x", "y", F.when(before, F.col("lo")).otherwise(F.col("mid")).alias("lo"), F.when(before, F.col("mid")).otherwise(F.col("hi")).alias("hi")))
    raise RuntimeError(f"lines did not settle in {rounds} rounds")
