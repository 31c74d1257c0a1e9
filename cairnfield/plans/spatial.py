"""Registered queries: measures, spatial joins, tiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..operators import graph, grid, measures, places
from ..sources import views as V
from .common import LINE, POLY, PT, SNAP, crosses, metres, near, rounded, to_segment

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def _polygon_segments(spark, sf):
    return measures.segments(V.polygons(spark, sf), ["id", "ring"], ("tier", "name")).withColumnRenamed("id", "fid")


@query(f"WITH {LINE} SELECT line, seq, round(x0, 7) AS x0, round(y0, 7) AS y0, round(x1, 7) AS x1, round(y1, 7) AS y1 FROM lseg")
def segments(spark, sf):
    return measures.segments(V.line_vertices(spark, sf), ["line"]).select("line", "seq", *[F.round(c, 7).alias(c) for c in ("x0", "y0", "x1", "y1")])


@query(f"WITH {LINE} SELECT line, count(*) AS positions FROM lv GROUP BY line")
def positions(spark, sf):
    return V.line_vertices(spark, sf).groupBy("line").agg(F.count(F.lit(1)).alias("positions"))


@query(f"WITH {LINE} SELECT line, round(min(x), 7) AS min_x, round(min(y), 7) AS min_y, round(max(x), 7) AS max_x, round(max(y), 7) AS max_y FROM lv GROUP BY line")
def bbox(spark, sf):
    return measures.bounds(V.line_vertices(spark, sf), ["line"]).select("line", *[F.round(c, 7).alias(c) for c in ("min_x", "min_y", "max_x", "max_y")])


@query(f"WITH {POLY} SELECT fid, ring, CAST(round(sum(x0*y1 - x1*y0)/2*1e8) AS BIGINT) AS area FROM pseg GROUP BY ALL")
def ring_area(spark, sf):
    a = measures.ring_areas(V.polygons(spark, sf), ["id", "ring"])
    return a.select(F.col("id").alias("fid"), "ring", F.round(F.col("area") * 1e8).cast("long").alias("area"))


@query(f"WITH {POLY} SELECT fid, ring, round(sum((x0 + x1)*(x0*y1 - x1*y0))/(3*sum(x0*y1 - x1*y0)), 4) AS cx, round(sum((y0 + y1)*(x0*y1 - x1*y0))/(3*sum(x0*y1 - x1*y0)), 4) AS cy FROM pseg GROUP BY ALL")
def ring_centroid(spark, sf):
    a = measures.ring_areas(V.polygons(spark, sf), ["id", "ring"])
    return a.select(F.col("id").alias("fid"), "ring", F.round("cx", 4).alias("cx"), F.round("cy", 4).alias("cy"))


@query(f"WITH {PT}, {POLY}, {near(1)} SELECT id, fid FROM near WHERE m = 0")
def point_in_polygon(spark, sf):
    return grid.within_polygons(V.points(spark, sf), _polygon_segments(spark, sf).select("fid", "ring", "x0", "y0", "x1", "y1"), 1.0).where("m = 0").select("id", "fid")


@query(f"WITH {PT}, {POLY}, {near(400)} SELECT id, fid, round(m, 2) AS metres FROM near")
def distance(spark, sf):
    return grid.within_polygons(V.points(spark, sf), _polygon_segments(spark, sf).select("fid", "ring", "x0", "y0", "x1", "y1"), 400.0).select("id", "fid", F.round("m", 2).alias("metres"))


_HAV = "2*6371008.8e0*asin(sqrt(power(sin((radians(y1) - radians(y0))/2), 2) + cos(radians(y0))*cos(radians(y1))*power(sin(radians(x1 - x0)/2), 2)))"


@query(f"WITH {LINE} SELECT line, round(sum({_HAV}), 2) AS metres FROM lseg GROUP BY line")
def line_length(spark, sf):
    return measures.lengths(V.line_vertices(spark, sf), ["line"]).select("line", F.round("metres", 2).alias("metres"))


@query(f"WITH {POLY}, a AS (SELECT fid, ring, abs(CAST(round(sum(x0*y1 - x1*y0)/2*1e8) AS BIGINT)) AS area FROM pseg GROUP BY ALL) SELECT fid, arg_max(ring, area*10 - ring) AS ring, max(area) AS area FROM a GROUP BY fid")
def largest_part(spark, sf):
    a = measures.ring_areas(V.polygons(spark, sf), ["id", "ring"]).select("id", "ring", F.abs(F.round(F.col("area") * 1e8).cast("long")).alias("area"))
    return a.groupBy(F.col("id").alias("fid")).agg(F.max(F.struct("area", -F.col("ring"), "ring")).alias("t")).select("fid", "t.ring", "t.area")


@query(f"""WITH {LINE}, s AS (SELECT *, greatest(1, CAST(ceil({metres('a.', 'b.')}) AS INT)) AS n FROM (SELECT line, seq, struct_pack(x := x0, y := y0) AS a, struct_pack(x := x1, y := y1) AS b FROM lseg WHERE line % 50 = 0)),
u AS (SELECT line, seq, a, b, n, unnest(range(CASE WHEN seq = 0 THEN 0 ELSE 1 END, n + 1)) AS i FROM s)
SELECT line, count(*) AS samples, round(min(a.x + (b.x - a.x)*i/n), 6) AS min_x, round(max(a.y + (b.y - a.y)*i/n), 6) AS max_y FROM u GROUP BY line""".replace("WHERE line % 50 = 0", ""))
def densify(spark, sf):
    d = measures.densified(V.line_vertices(spark, sf), ["line"])
    return d.groupBy("line").agg(F.count(F.lit(1)).alias("samples"), F.round(F.min("x"), 6).alias("min_x"), F.round(F.max("y"), 6).alias("max_y"))


def _shifted(spark, sf):
    """The same lines, with every third one moved north by 13 m from its middle on."""
    v = V.line_vertices(spark, sf)
    return v.withColumn("y", F.col("y") + F.when((F.col("line") % 3 == 0) & (F.col("seq") >= 2), 0.00012).otherwise(0.0))


_SHIFTED = "s2 AS (SELECT line, seq, x0, y0 + CASE WHEN line % 3 = 0 AND seq >= 2 THEN 0.00012e0 ELSE 0e0 END AS y0, x1, y1 + CASE WHEN line % 3 = 0 AND seq + 1 >= 2 THEN 0.00012e0 ELSE 0e0 END AS y1 FROM lseg)"


def _off_runs(name: str, own: str, other: str) -> str:
    """Runs of samples of own segments that lie off the other's, as SQL: name(line, run, points, m)."""
    return f"""{name}_t AS (SELECT *, greatest(1, CAST(ceil({metres('a.', 'b.')}) AS INT)) AS n FROM (SELECT line, seq, struct_pack(x := x0, y := y0) AS a, struct_pack(x := x1, y := y1) AS b FROM {own})),
{name}_s AS (SELECT line, seq, i, {rounded('a.x + (b.x - a.x)*(i/n)')} AS x, {rounded('a.y + (b.y - a.y)*(i/n)')} AS y FROM (SELECT *, unnest(range(CASE WHEN seq = 0 THEN 0 ELSE 1 END, n + 1)) AS i FROM {name}_t)),
{name}_d AS (SELECT p.line, p.seq, p.i, p.x, p.y, min({to_segment('p.', 's.')}) AS m FROM {name}_s p JOIN {other} s USING (line) GROUP BY ALL),
{name}_o AS (SELECT *, pos - row_number() OVER (PARTITION BY line ORDER BY seq, i) AS run FROM (SELECT *, row_number() OVER (PARTITION BY line ORDER BY seq, i) AS pos FROM {name}_d) WHERE m > 3),
{name}_e AS (SELECT line, run, {metres('prev.', 'cur.')} AS step FROM (SELECT line, run, struct_pack(x := lag(x) OVER w, y := lag(y) OVER w) AS prev, struct_pack(x := x, y := y) AS cur FROM {name}_o WINDOW w AS (PARTITION BY line, run ORDER BY pos))),
{name} AS (SELECT line, run, count(*) AS points, sum(step) AS m FROM {name}_e GROUP BY ALL HAVING count(*) > 1)"""


@query(f"WITH {LINE}, {_SHIFTED}, {_off_runs('added', 's2', 'lseg')} SELECT line, points, round(m) AS metres FROM added")
def off_runs(spark, sf):
    base = measures.segments(V.line_vertices(spark, sf), ["line"]).drop("seq")
    return measures.off_runs(_shifted(spark, sf), base, ["line"], 3.0).select("line", "points", F.round("metres").alias("metres"))


@query(f"""WITH {LINE}, {_SHIFTED}, {_off_runs('added', 's2', 'lseg')}, {_off_runs('dropped', 'lseg', 's2')}
SELECT line, count(*) AS runs, round(sum(d)) AS dropped_m, round(sum(a)) AS added_m FROM (SELECT line, 0e0 AS d, m AS a FROM added UNION ALL SELECT line, m, 0e0 FROM dropped) GROUP BY line""")
def moved(spark, sf):
    got = measures.moved(V.line_vertices(spark, sf), _shifted(spark, sf), ["line"], 3.0)
    return got.select("line", "runs", F.round("dropped_m").alias("dropped_m"), F.round("added_m").alias("added_m"))


@query(f"WITH {SNAP} SELECT b.id, round({metres('b.', 'a.')}, 2) AS metres FROM bef b JOIN aft a USING (id) WHERE a.x <> b.x")
def point_moved(spark, sf):
    b, a = V.snapshot(spark, sf, "before"), V.snapshot(spark, sf, "after").select("id", F.col("x").alias("ax"), F.col("y").alias("ay"))
    return b.join(a, "id").where("ax <> x").select("id", F.round(geo.metres(F.col("x"), F.col("y"), F.col("ax"), F.col("ay")), 2).alias("metres"))


@query()
def simplify(spark, sf):
    return measures.simplified(V.line_vertices(spark, sf), ["line"], 0.00008).select("line", "seq")


@query(f"""WITH {POLY}, b AS (SELECT id, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM poly GROUP BY id), z AS (SELECT *, unnest(range(0, 16)) AS z FROM b),
t AS (SELECT id, z, CAST(floor((x0 + 180)/360*power(2e0, z)) AS INT) AS tx0, CAST(floor((x1 + 180)/360*power(2e0, z)) AS INT) AS tx1,
 CAST(floor((1 - ln(tan(radians(y1)) + 1/cos(radians(y1)))/3.141592653589793e0)/2*power(2e0, z)) AS INT) AS ty0, CAST(floor((1 - ln(tan(radians(y0)) + 1/cos(radians(y0)))/3.141592653589793e0)/2*power(2e0, z)) AS INT) AS ty1 FROM z)
SELECT CAST(z AS INT) AS zoom, count(DISTINCT (tx, ty)) AS tiles, count(*) AS covers FROM (SELECT id, z, tx, unnest(range(ty0, ty1 + 1)) AS ty FROM (SELECT *, unnest(range(tx0, tx1 + 1)) AS tx FROM t)) GROUP BY z""")
def tile_cover(spark, sf):
    b = measures.bounds(V.polygons(spark, sf), ["id"]).withColumn("zoom", F.explode(F.sequence(F.lit(0), F.lit(15))))
    z = F.col("zoom")
    tx = F.explode(F.sequence(geo.tile_x(F.col("min_x"), z), geo.tile_x(F.col("max_x"), z))).alias("tx")
    ty = F.explode(F.sequence(geo.tile_y(F.col("max_y"), z), geo.tile_y(F.col("min_y"), z))).alias("ty")
    return b.select("id", "zoom", "max_y", "min_y", tx).select("id", "zoom", "tx", ty).groupBy("zoom").agg(F.count_distinct("tx", "ty").alias("tiles"), F.count(F.lit(1)).alias("covers"))


@query(f"""WITH {LINE} SELECT line, round((min(x) + max(x))/2, 6) AS mid_x, round((min(y) + max(y))/2, 6) AS mid_y, round(greatest(max(x) - min(x) + 0.0004e0, 0.002e0, max(y) - min(y) + 0.0004e0), 6) AS width, round(max(y) - min(y) + 0.0004e0, 6) AS height FROM lv GROUP BY line""")
def frame(spark, sf):
    f = measures.frames(V.line_vertices(spark, sf), ["line"], 0.0002, 0.002)
    return f.select("line", *[F.round(c, 6).alias(c) for c in ("mid_x", "mid_y", "width", "height")])


@query(f"""WITH {PT}, {POLY}, {near(500)}, own AS (SELECT DISTINCT id AS fid, name FROM poly), lab AS (SELECT n.*, regexp_replace(lower('(New) Supplier ' || lpad(CAST(n.id % 100 AS VARCHAR), 9, '0') || ', east side'), '^\\s*\\([^)]*\\)\\s*', '') AS label FROM near n)
SELECT l.id, arg_min(l.fid, (CASE WHEN starts_with(regexp_replace(label, '[^a-z0-9]+', '', 'g'), regexp_replace(lower(name), '[^a-z0-9]+', '', 'g')) THEN 0 ELSE 1 END, l.m, l.fid)) AS parent FROM lab l JOIN own USING (fid) GROUP BY l.id""")
def preferred_nearest(spark, sf):
    """Each point's area within 500 m: the one that its label names, else the nearest."""
    label = F.concat(F.lit("(New) Supplier "), F.lpad((F.col("id") % 100).cast("string"), 9, "0"), F.lit(", East side"))
    areas = V.polygons(spark, sf).select(F.col("id").alias("fid"), "name").distinct()
    return places.preferred_within(V.points(spark, sf).select("id", "x", "y", label.alias("label")), _polygon_segments(spark, sf), areas, 500.0)


def tiers(spark, sf):
    """Each point's nearest area within 500 m, all of tier 0 before any of tier 1; ties to the lower id."""
    segs = _polygon_segments(spark, sf)
    tier = segs.groupBy("fid").agg(F.min("tier").alias("tier"), F.min("name").alias("owner"))
    n = grid.within_polygons(V.points(spark, sf), segs.select("fid", "ring", "x0", "y0", "x1", "y1"), 500.0).join(tier, "fid")
    best = n.groupBy("id").agg(F.min(F.struct("tier", "m", "fid", "owner")).alias("t"))
    return best.select("id", F.col("t.fid").alias("parent"), F.col("t.tier").alias("tier"), F.concat(F.lit("Spot, "), "t.owner").alias("name"), F.round("t.m", 2).alias("metres"))


@query(f"""WITH {PT}, {POLY}, {near(500)}, j AS (SELECT n.*, p.tier, p.owner FROM near n JOIN (SELECT id AS fid, min(tier) AS tier, min(name) AS owner FROM poly GROUP BY id) p USING (fid)), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY tier, m, fid) AS rn FROM j)
SELECT id, fid AS parent, tier, 'Spot, ' || owner AS name, round(m, 2) AS metres FROM r WHERE rn = 1""")
def tiered_nearest(spark, sf):
    return tiers(spark, sf)


@query(f"WITH {PT} SELECT a.id AS a, b.id AS b, round({metres('a.', 'b.')}, 2) AS metres FROM pt a JOIN pt b ON a.id < b.id WHERE {metres('a.', 'b.')} <= 150")
def near_pairs(spark, sf):
    return grid.near_points(V.points(spark, sf), 150.0).select("a", "b", F.round("m", 2).alias("metres"))


def _sides(spark, sf):
    """Shapes of all kinds: parts as points, lines, areas."""
    lines = measures.segments(V.line_vertices(spark, sf), ["line"]).withColumnRenamed("line", "id")
    return grid.sides_of(V.snapshot(spark, sf, "before").where("id % 20 = 1"), lines, _polygon_segments(spark, sf).withColumnRenamed("fid", "id"))


_AREA_HOLDS = "SELECT {p}.id, s.fid FROM {points} {p} JOIN pseg s ON true GROUP BY {p}.id, s.fid HAVING sum(CASE WHEN s.ring = 0 THEN {hit} ELSE 0 END) % 2 = 1 AND sum(CASE WHEN s.ring > 0 THEN {hit} ELSE 0 END) % 2 = 0"


@query(f"""WITH {PT}, {POLY}, {LINE}, {SNAP}, side AS (SELECT 'point' AS kind, id AS sid, x AS x0, y AS y0, x AS x1, y AS y1 FROM bef WHERE id % 20 = 1 UNION ALL SELECT 'line', line, x0, y0, x1, y1 FROM lseg UNION ALL SELECT 'area', fid, x0, y0, x1, y1 FROM pseg),
inside AS ({_AREA_HOLDS.format(p='p', points='pt', hit=crosses('p.', 's.'))}),
d AS (SELECT p.id, s.kind, s.sid, {to_segment('p.', 's.')} AS m FROM pt p, side s UNION ALL SELECT id, 'area', fid, 0e0 FROM inside),
k AS (SELECT id, kind, min(m) AS m FROM d GROUP BY ALL)
SELECT id, kind, round(m, 2) AS metres FROM k UNION ALL SELECT id, 'volume', 'inf'::DOUBLE FROM pt""")
def nearest_shapes(spark, sf):
    """How far each point is from the nearest point, line and area, however far, and from a kind that isn't there."""
    got = grid.nearest_shapes(V.points(spark, sf), _sides(spark, sf), ["point", "line", "area", "volume"], 100.0)
    return got.select("id", "kind", F.round("m", 2).alias("metres"))


@query(f"""WITH {POLY}, v AS (SELECT DISTINCT id, x, y FROM poly), near AS (SELECT DISTINCT v.id AS a, s.fid AS b FROM v JOIN pseg s ON v.id <> s.fid WHERE {to_segment('v.', 's.')} <= 150),
q AS (SELECT row_number() OVER () AS id, id AS own, x, y FROM v), inside AS ({_AREA_HOLDS.format(p='p', points='q', hit=crosses('p.', 's.'))}),
u AS (SELECT a, b FROM near UNION ALL SELECT own, fid FROM inside JOIN q USING (id) WHERE own <> fid)
SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM u""")
def touching_pairs(spark, sf):
    areas = grid.sides_of(areas=_polygon_segments(spark, sf).withColumnRenamed("fid", "id"))
    return grid.touching_shapes(areas, 150.0).select("a.sid", "b.sid").toDF("a", "b")


@query(f"""WITH {PT}, {POLY}, t AS (SELECT id, min(x) AS x, min(y) AS y FROM poly GROUP BY id), d AS (SELECT pt.id, t.id AS target, {metres('pt.', 't.')} AS m FROM pt, t), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY m, target) AS rn FROM d)
SELECT id, target, round(m, 2) AS metres FROM r WHERE rn = 1""")
def nearest_node(spark, sf):
    targets = V.polygons(spark, sf).groupBy("id").agg(F.min("x").alias("x"), F.min("y").alias("y"))
    return grid.nearest_point(V.points(spark, sf), targets, 1000.0).select("id", "target", F.round("m", 2).alias("metres"))


@query(f"""WITH {LINE}, b AS (SELECT line, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM lv WHERE line % 40 = 0 GROUP BY line)
SELECT a.line AS a, b.line AS b FROM b a JOIN b ON a.line < b.line AND a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1""".replace("WHERE line % 40 = 0 ", ""))
def bbox_overlap(spark, sf):
    b = measures.bounds(V.line_vertices(spark, sf), ["line"]).withColumnRenamed("line", "id")
    return grid.near_boxes(b, 0.0, 0.0, 200.0)


@query(f"""WITH {POLY}, b AS (SELECT id, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM poly GROUP BY id)
SELECT a.id AS a, b.id AS b FROM b a JOIN b ON a.id < b.id AND greatest(a.x0 - b.x1, b.x0 - a.x1, 0) <= 0.002e0 AND greatest(a.y0 - b.y1, b.y0 - a.y1, 0) <= 0.002e0""")
def bbox_near(spark, sf):
    return grid.near_boxes(measures.bounds(V.polygons(spark, sf), ["id"]), 0.002, 0.002, 250.0)


@query(f"""WITH {LINE}, c AS (SELECT line, x + 0.00002e0 AS x, y + 0.00001e0 AS y, line % 2 AS late FROM lv WHERE seq = 1), n AS (SELECT c.line, c.late, arg_min(v.seq, ({metres('c.', 'v.')}, v.seq)) AS cut FROM c JOIN lv v ON v.line = c.line GROUP BY ALL)
SELECT lv.line, count(*) AS kept, min(lv.seq) AS first, max(lv.seq) AS last FROM lv LEFT JOIN n USING (line) WHERE n.line IS NULL OR (late = 0 AND lv.seq <= cut) OR (late = 1 AND lv.seq >= cut) GROUP BY lv.line""")
def cut_lines(spark, sf):
    v = V.line_vertices(spark, sf)
    cuts = v.where("seq = 1").select("line", (F.col("x") + 0.00002).alias("x"), (F.col("y") + 0.00001).alias("y"), F.when(F.col("line") % 2 == 0, "before").otherwise("after").alias("side"))
    return graph.cut_at(v, cuts).groupBy("line").agg(F.count(F.lit(1)).alias("kept"), F.min("seq").alias("first"), F.max("seq").alias("last"))


@query(f"""WITH {LINE}, {POLY}, t AS (SELECT id, min(x) AS x, min(y) AS y FROM poly GROUP BY id) SELECT t.id, round(min({to_segment('t.', 's.')}), 2) AS metres FROM t, lseg s GROUP BY t.id""")
def snap_to_lines(spark, sf):
    """How far the south-west corner of each area is from the nearest place on a line."""
    corners = V.polygons(spark, sf).groupBy("id").agg(F.min("x").alias("x"), F.min("y").alias("y"))
    lines = measures.segments(V.line_vertices(spark, sf), ["line"])
    return grid.snap_to_lines(corners, lines, 100.0).select("id", F.round("m", 2).alias("metres"))


_ODD = "(SELECT ring, sum({hit}) % 2 AS odd FROM pseg s WHERE s.fid = {p}fid GROUP BY ring)"


def _inside(p: str) -> str:
    """Whether point p (fid, x, y) lies in its area, as SQL."""
    odd = _ODD.format(hit=crosses(p, "s."), p=p)
    return f"(SELECT max(CASE WHEN ring = 0 THEN odd ELSE 0 END) = 1 AND max(CASE WHEN ring > 0 THEN odd ELSE 0 END) = 0 FROM {odd})"


# the areas of these tables have a span on the row of their centroid, so the sweep of further rows isn't spelt out
@query(f"""WITH {POLY}, c AS (SELECT fid, sum((x0 + x1)*(x0*y1 - x1*y0))/(3*sum(x0*y1 - x1*y0)) AS x, sum((y0 + y1)*(x0*y1 - x1*y0))/(3*sum(x0*y1 - x1*y0)) AS y FROM pseg WHERE ring = 0 GROUP BY fid),
h AS (SELECT c.fid, c.y, s.x0 + (c.y - s.y0)/(s.y1 - s.y0)*(s.x1 - s.x0) AS hit FROM c JOIN pseg s USING (fid) WHERE (s.y0 > c.y) <> (s.y1 > c.y)), g AS (SELECT fid, y, hit, lead(hit) OVER (PARTITION BY fid ORDER BY hit) AS nx FROM h),
m AS (SELECT fid, (hit + nx)/2 AS x, y, nx - hit AS w FROM g WHERE nx > hit), b AS (SELECT fid, arg_min(x, (round(-w, 9), x)) AS x FROM m WHERE {_inside('m.')} GROUP BY fid)
SELECT c.fid, round(CASE WHEN {_inside('c.')} THEN c.x ELSE coalesce(b.x, c.x) END, 4) AS x, round(c.y, 4) AS y FROM c LEFT JOIN b USING (fid)""")
def label_anchor(spark, sf):
    got = measures.label_anchors(V.polygons(spark, sf))
    return got.select(F.col("id").alias("fid"), F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


@query(f"""WITH RECURSIVE {PT}, e AS (SELECT a.id AS a, b.id AS b FROM pt a JOIN pt b ON a.id < b.id WHERE {metres('a.', 'b.')} <= 300), bo AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(node, root) AS (SELECT DISTINCT a, a FROM bo UNION SELECT bo.b, r.root FROM r JOIN bo ON bo.a = r.node)
SELECT node, min(root) AS root FROM r GROUP BY node""")
def component_roots(spark, sf):
    return grid.linked_points(V.points(spark, sf), 300.0)


QUERIES["components"] = QUERIES.pop("component_roots")
SQL["components"] = SQL.pop("component_roots")
