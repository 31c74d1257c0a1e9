"""Registered queries: networks, paths, fitting, lines put together."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import conflate, connect, graph, grid, measures, trails
from ..operators.ranks import ranked
from ..sources import views as V
from ..storage import cut
from .common import LINE, POLY, PT, X, Y, metres, near, to_segment

QUERIES, SQL = {}, {}
_HAV = "2*6371008.8e0*asin(sqrt(power(sin((radians(y1) - radians(y0))/2), 2) + cos(radians(y0))*cos(radians(y1))*power(sin(radians(x1 - x0)/2), 2)))"


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


@query(f"WITH {LINE}, e AS (SELECT round(x0, 5) AS x0, round(y0, 5) AS y0, round(x1, 5) AS x1, round(y1, 5) AS y1 FROM lseg), c AS (SELECT CASE WHEN (x0, y0) < (x1, y1) THEN (x0, y0, x1, y1) ELSE (x1, y1, x0, y0) END AS t FROM e WHERE (x0, y0) <> (x1, y1)) SELECT count(DISTINCT t) AS edges FROM c")
def line_graph(spark, sf):
    return graph.line_graph(V.line_vertices(spark, sf), ["line"], 5).agg(F.count(F.lit(1)).alias("edges"))


_EDGES = "ce AS (SELECT least(l_partkey, l_suppkey) AS a, greatest(l_partkey, l_suppkey) AS b, min((l_orderkey, l_linenumber, l_returnflag)) AS t FROM lineitem WHERE l_partkey <> l_suppkey GROUP BY 1, 2)"


def _net(spark, sf):
    rows = V.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"), F.col("l_returnflag").alias("type"), F.struct("l_orderkey", "l_linenumber").alias("pos"))
    return graph.canonical_edges(rows)


@query(f"WITH {_EDGES} SELECT a, b, t[3] AS type FROM ce")
def canonical_edges(spark, sf):
    return _net(spark, sf)


_NET_M = "sqrt(power((" + X.format(k="b") + " - " + X.format(k="a") + ")*cos(radians(44.46e0))*111320e0, 2) + power((" + Y.format(k="b") + " - " + Y.format(k="a") + ")*111132e0, 2))"


@query(f"WITH {_EDGES} SELECT t[3] AS type, count(*) AS edges, CAST(sum(CAST(round({_NET_M}) AS BIGINT)) AS BIGINT) AS metres FROM ce GROUP BY 1")
def edge_lengths(spark, sf):
    ends = [f(F.col(k)) for k in ("a", "b") for f in (V.place_x, V.place_y)]
    return _net(spark, sf).groupBy("type").agg(F.count(F.lit(1)).alias("edges"), F.sum(F.round(geo.net_metres(*ends)).cast("long")).alias("metres"))


_GRID = "g AS (SELECT p_partkey AS k, p_size AS w FROM part), ge AS (SELECT a.k AS a, a.k + 1 AS b, 1 + a.w AS c FROM g a WHERE a.k % 40 <> 39 AND EXISTS (SELECT 1 FROM g WHERE k = a.k + 1) UNION ALL SELECT a.k, a.k + 40, 2 + a.w FROM g a WHERE EXISTS (SELECT 1 FROM g WHERE k = a.k + 40)), gb AS (SELECT a, b, c FROM ge UNION ALL SELECT b, a, c FROM ge)"


def _grid(spark, sf):
    """A street grid 40 wide over part keys, with costs by p_size."""
    k = F.col("p_partkey")
    g = V.table(spark, sf, "part").select(k.alias("a"), F.col("p_size").alias("w"))
    ends = g.select(F.col("a").alias("b"))
    right = g.where("a % 40 <> 39").select("a", (F.col("a") + 1).alias("b"), (F.col("w") + 1).cast("double").alias("cost"))
    up = g.select("a", (F.col("a") + 40).alias("b"), (F.col("w") + 2).cast("double").alias("cost"))
    return right.unionByName(up).join(ends, "b").select("a", "b", "cost")


@query()
def connectors(spark, sf):
    """Suppliers led along a street grid over part keys, 40 wide, to every eleventh crossing, the only ones that the network has."""
    at = lambda k: ((F.lit(-93.3) + (k % 40).cast("double") / 2e3).alias("x"), (F.lit(44.4) + F.floor(k / 40).cast("double") * 4e-4).alias("y"))
    k, s = F.col("p_partkey"), F.col("s_suppkey")
    vertices = V.table(spark, sf, "part").select(k.alias("id"), *at(k))
    # a block is 45 m at most; some streets are slow
    edges = _grid(spark, sf).select("a", "b", (F.col("cost") + 45).alias("cost"))
    # twenty crossings for each supplier, so they spread over the whole grid, neighbours' ids mixed
    row = s - s % 64 + s % 64 * 37 % 64
    houses = V.table(spark, sf, "supplier").select(s.alias("id"), (F.lit(-93.3001) + (s * 7919 % 2001).cast("double") / 1e5).alias("x"), (F.lit(44.4002) + row.cast("double") * 2e-4).alias("y"))
    found = connect.connectors(houses, vertices.where("id % 11 = 0"), vertices, edges, 45.0, 25.0, 150.0)
    return found.select("anchor", "round", "step", "vertex")


@query(f"""WITH RECURSIVE {_GRID}, r(node, cost) USING KEY (node) AS (SELECT CAST(45 AS BIGINT), CAST(0 AS BIGINT) UNION SELECT gb.b, min(r.cost + gb.c) FROM r JOIN gb ON gb.a = r.node LEFT JOIN recurring.r AS old ON old.node = gb.b WHERE r.cost + gb.c <= 120 AND (old.cost IS NULL OR r.cost + gb.c < old.cost) GROUP BY gb.b)
SELECT node, cost FROM r""")
def sssp(spark, sf):
    starts = V.table(spark, sf, "part").where("p_partkey = 45").select(F.col("p_partkey").alias("node"))
    return graph.shortest_paths(_grid(spark, sf), starts, 120.0).select("node", F.col("cost").cast("long").alias("cost"))


@query("""WITH p AS (SELECT c_custkey % 97 AS p, c_nationkey AS q, c_acctbal AS x FROM customer), s AS (SELECT count(*) AS n, avg(p) AS mp, avg(q) AS mq, avg(x) AS mx, var_pop(p) AS pp, var_pop(q) AS qq, covar_pop(p, q) AS pq, covar_pop(p, x) AS px, covar_pop(q, x) AS qx FROM p),
f AS (SELECT *, (px*qq - qx*pq)/(pp*qq - pq*pq) AS a, (qx*pp - px*pq)/(pp*qq - pq*pq) AS b FROM s) SELECT n, round(a, 4) AS a, round(b, 4) AS b, round(mx - a*mp - b*mq, 4) AS c FROM f""")
def affine_fit(spark, sf):
    """The plane through account balances over two numbers of each customer."""
    rows = V.table(spark, sf, "customer").select((F.col("c_custkey") % 97).cast("double").alias("px"), F.col("c_nationkey").cast("double").alias("py"), F.col("c_acctbal").alias("x"), F.lit(0.0).alias("y"))
    fit = graph.affine_fit(rows)[0]
    return rows.agg(F.count(F.lit(1)).alias("n")).select("n", *[F.lit(round(float(v), 4)).alias(k) for k, v in zip("abc", fit, strict=True)])


@query()
def icp(spark, sf):
    """Corners of all areas on a plan in other units, laid back on the areas' outlines: the map, and the mean metres off before and after."""
    v = V.polygons(spark, sf)
    nodes = v.where("ring = 0 and seq < 4").select((F.col("id") * 8 + F.col("seq")).alias("id"), ((F.col("x") + 93.2) * 1e4).alias("px"), ((F.col("y") - 44.45) * 1e4).alias("py"))
    # the corners of the lowest and the highest id are known, but for a few metres
    ends = v.agg(F.array(F.min("id"), F.max("id")).alias("ids")).select(F.explode("ids").alias("id")).distinct()
    off = (F.col("seq") - 1.5) * 0.00003
    anchors = v.where("ring = 0 and seq < 4").join(ends, "id")
    anchors = anchors.select(((F.col("x") + 93.2) * 1e4).alias("px"), ((F.col("y") - 44.45) * 1e4).alias("py"), (F.col("x") + off).alias("x"), (F.col("y") - off).alias("y"))
    lines = measures.segments(v, ["id", "ring"]).select("x0", "y0", "x1", "y1")
    first, last = graph.affine_fit(anchors), graph.icp(nodes, anchors, lines)

    def told(fit, turn):
        terms = [F.lit(float(x)).alias(f"{k}{i}") for k, c in zip("xy", fit, strict=True) for i, x in enumerate(c)]
        return grid.snap_to_lines(graph.mapped(nodes, fit), lines, 40.0).agg(F.avg("m").alias("mean_m")).select(F.lit(turn).alias("turn"), "mean_m", *terms)

    return told(first, "before").unionAll(told(last, "after"))


@query(f"""WITH RECURSIVE {LINE}, tv AS (SELECT line % 500 AS trail, * FROM lv), ts AS (SELECT line % 500 AS trail, * FROM lseg), e AS (SELECT DISTINCT p.line AS a, s.line AS b FROM tv p JOIN ts s ON s.trail = p.trail AND s.line <> p.line WHERE {to_segment('p.', 's.')} <= 400),
bo AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(node, root) AS (SELECT DISTINCT line, line FROM lv UNION SELECT bo.b, r.root FROM r JOIN bo ON bo.a = r.node), pt AS (SELECT node AS line, min(root) AS part FROM r GROUP BY node),
m AS (SELECT line, sum({_HAV}) AS metres FROM lseg GROUP BY line), n AS (SELECT line, count(*) AS n FROM lv GROUP BY line)
SELECT line % 500 AS trail, count(*) AS pieces, count(DISTINCT part) AS parts, round(coalesce(sum(metres), 0), 1) AS metres, CAST(sum(n) AS BIGINT) AS vertices FROM n JOIN pt USING (line) LEFT JOIN m USING (line) GROUP BY 1""")
def assemble_lines(spark, sf):
    v = V.line_vertices(spark, sf).withColumn("trail", F.col("line") % 500)
    return graph.assembled(v, 400.0).select("trail", "pieces", "parts", F.round("metres", 1).alias("metres"), "vertices")


@query(f"WITH {LINE}, k AS (SELECT DISTINCT l_returnflag || l_linestatus AS kind, l_orderkey AS line FROM lineitem), p AS (SELECT kind, line, dense_rank() OVER (PARTITION BY kind ORDER BY line) - 1 AS part FROM k) SELECT kind, CAST(part AS BIGINT) AS part, seq, round(x, 7) AS x, round(y, 7) AS y FROM p JOIN lv USING (line)")
def merge_by_kind(spark, sf):
    kinds = V.table(spark, sf, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("kind"), F.col("l_orderkey").alias("line")).distinct()
    got = graph.merged_lines(V.line_vertices(spark, sf), kinds)
    return got.select("kind", "part", "seq", F.round("x", 7).alias("x"), F.round("y", 7).alias("y"))


def _apart(v, reach=2000.0):
    """(id, m): metres from each area's vertices (id, x, y) to the nearest vertex of another, however far."""
    return grid.nearest_other(v, reach)


@query(f"WITH {PT}, {POLY}, v AS (SELECT DISTINCT id, x, y FROM poly WHERE ring = 0), d AS (SELECT a.id, min({metres('a.', 'b.')}) AS m FROM v a JOIN v b ON a.id <> b.id GROUP BY a.id), r AS (SELECT m, row_number() OVER (ORDER BY m) - 1 AS rn, count(*) OVER () AS n FROM d) SELECT n, round(m, 2) AS upper_median FROM r WHERE rn = n // 2")
def upper_median(spark, sf):
    v = V.polygons(spark, sf).where("ring = 0").select("id", "x", "y").distinct()
    found = cut(_apart(v))
    # the upper median is an order statistic, so no interpolation
    n = found.count()
    return ranked(found, ["m", "id"]).where(F.col("rank") == n // 2 + 1).select(F.lit(n).cast("long").alias("n"), F.round("m", 2).alias("upper_median"))


@query("WITH a AS (SELECT n_name AS name, n_nationkey AS id FROM nation), al(alias, of) AS (SELECT 'Alias ' || n_name, n_name FROM nation WHERE n_nationkey % 2 = 0), al2 AS (SELECT alias, id FROM al JOIN a ON a.name = al.of), k AS (SELECT name, id FROM a UNION ALL SELECT alias, id FROM al2) SELECT s_suppkey AS button, k.id AS place FROM supplier JOIN nation ON n_nationkey = s_nationkey LEFT JOIN k ON k.name = CASE WHEN s_suppkey % 2 = 0 THEN 'Alias ' || n_name ELSE n_name END")
def entrances(spark, sf):
    nation = V.table(spark, sf, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("place"))
    aliases = nation.where("place % 2 = 0").select(F.concat(F.lit("Alias "), "name").alias("name"), "place")
    buttons = V.table(spark, sf, "supplier").join(V.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("button"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("Alias "), "n_name")).otherwise(F.col("n_name")).alias("name"))
    return buttons.join(nation.unionByName(aliases), "name", "left").select("button", "place")


@query(f"""WITH RECURSIVE {POLY}, pc AS (SELECT id*1000 + ring*100 + seq AS id, x, y FROM poly), {near(2000, "pc")}, e AS (SELECT DISTINCT fid AS a, id // 1000 AS b FROM near WHERE fid < id // 1000 AND fid % 10 = (id // 1000) % 10),
r(id, root) AS (SELECT min(s_suppkey), min(s_suppkey) FROM supplier GROUP BY s_suppkey % 10 UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id) SELECT s_suppkey AS id, coalesce(r.root, s_suppkey) AS root FROM supplier LEFT JOIN r ON r.id = s_suppkey""")
def merge_pieces(spark, sf):
    return conflate.merged_pieces(V.polygons(spark, sf).withColumn("name", F.col("id") % 10), 2000.0)


@query("SELECT zoom, first, prev_last, prev_last IS NOT NULL AND prev_last + 1 <> first AS gap FROM (SELECT p_size AS zoom, min(p_partkey) AS first, lag(max(p_partkey)) OVER (ORDER BY p_size) AS prev_last FROM part GROUP BY p_size)")
def tier_gaps(spark, sf):
    tiers = V.table(spark, sf, "part").groupBy(F.col("p_size").alias("zoom")).agg(F.min("p_partkey").alias("first"), F.max("p_partkey").alias("last"))
    prev = F.lag("last").over(Window.orderBy("zoom"))  # tiers are a few dozen
    return tiers.select("zoom", "first", prev.alias("prev_last")).withColumn("gap", F.col("prev_last").isNotNull() & (F.col("prev_last") + 1 != F.col("first")))


def _segment_layer(spark, sf):
    """Lines as features of two parts, every thirteenth drawn twice."""
    v = V.line_vertices(spark, sf).select(F.col("line").alias("fid"), (F.col("seq") >= 3).cast("int").alias("part"), F.when(F.col("seq") >= 3, F.col("seq") - 3).otherwise(F.col("seq")).alias("seq"), "x", "y")
    return v.withColumn("row", F.explode(F.when(F.col("fid") % 13 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))


def _named_segments(spark, sf):
    """Each customer's orders as the segments of a trail: some keys that aren't there, parts, and cuts, some of them far off."""
    k = F.col("o_orderkey")
    o = V.table(spark, sf, "orders").select("o_orderkey", "o_custkey").distinct()
    fid = F.when(k % 11 == 0, k + 10_000_000).otherwise(k)
    part = F.when(k % 3 == 0, (k % 5).cast("int"))
    side = F.when(k % 6 == 0, "until").when(k % 6 == 3, "from").when(k % 17 == 0, "until")
    east = F.when(k % 7 == 0, 0.001).otherwise(0.00002)
    return o.select(F.col("o_custkey").alias("trail"), k.alias("nth"), fid.alias("fid"), part.alias("part"), side.alias("side"), (V.place_x(k) + (37 + k % 41).cast("double") / 1e5 + east).alias("x"), (V.place_y(k) + 0.0001).alias("y"))


_TRAILS = f"""{LINE}, lay AS (SELECT CASE WHEN line % 13 = 0 THEN 2 ELSE 1 END AS features, line AS fid, CASE WHEN seq >= 3 THEN 1 ELSE 0 END AS part, CASE WHEN seq >= 3 THEN seq - 3 ELSE seq END AS seq, x, y FROM lv),
held AS (SELECT fid, max(features) AS features, max(part) + 1 AS parts FROM lay GROUP BY fid),
o AS (SELECT DISTINCT o_orderkey AS k, o_custkey AS trail FROM orders),
want AS (SELECT trail, k AS nth, CASE WHEN k % 11 = 0 THEN k + 10000000 ELSE k END AS fid, CASE WHEN k % 3 = 0 THEN k % 5 END AS part, CASE WHEN k % 6 = 0 THEN 'until' WHEN k % 6 = 3 THEN 'from' WHEN k % 17 = 0 THEN 'until' END AS side,
  {X.format(k='k')} + CAST(37 + k % 41 AS DOUBLE)/1e5 + CASE WHEN k % 7 = 0 THEN 0.001e0 ELSE 0.00002e0 END AS x, {Y.format(k='k')} + 0.0001e0 AS y FROM o),
met AS (SELECT w.*, h.features, h.parts, CASE WHEN h.fid IS NULL THEN 'not in the layer' WHEN features > 1 THEN 'in the layer twice' WHEN w.part NOT BETWEEN 0 AND parts - 1 THEN 'no such part' WHEN side IS NOT NULL AND w.part IS NULL AND parts > 1 THEN 'cut in a segment of several parts' END AS first_why FROM want w LEFT JOIN held h USING (fid)),
vert AS (SELECT m.trail, m.nth, m.side, l.part, l.seq, l.x, l.y, {metres('m.', 'l.')} AS m FROM met m JOIN lay l USING (fid) WHERE first_why IS NULL AND (m.part IS NULL OR m.part = l.part)),
near AS (SELECT trail, nth, arg_min(seq, (m, seq)) AS at, min(m) AS m FROM vert WHERE side IS NOT NULL GROUP BY ALL)"""


@query(f"""WITH {_TRAILS}, k AS (SELECT v.* FROM vert v LEFT JOIN near n USING (trail, nth) WHERE v.side IS NULL OR (n.m <= 5 AND ((v.side = 'until' AND v.seq <= n.at) OR (v.side = 'from' AND v.seq >= n.at))))
SELECT trail, nth, CAST(part AS INT) AS part, count(*) AS vertices, min(seq) AS first, max(seq) AS last, round(sum(x), 6) AS x FROM k GROUP BY ALL""")
def trail_pieces(spark, sf):
    """Trails from segment keys, with their parts and cuts."""
    p = trails.trail_pieces(_segment_layer(spark, sf), _named_segments(spark, sf))
    return p.groupBy("trail", "nth", "part").agg(F.count(F.lit(1)).alias("vertices"), F.min("seq").alias("first"), F.max("seq").alias("last"), F.round(F.sum("x"), 6).alias("x"))


@query(f"""WITH {_TRAILS} SELECT trail, nth, fid, coalesce(first_why, 'no vertex near its cut') AS why FROM met LEFT JOIN near n USING (trail, nth) WHERE first_why IS NOT NULL OR (side IS NOT NULL AND (n.m IS NULL OR n.m > 5))""")
def trail_faults(spark, sf):
    """Which segment keys of trails are stale, doubled, out of range or cut at no vertex."""
    return trails.trail_faults(_segment_layer(spark, sf), _named_segments(spark, sf))
