"""Registered queries: what is shown of places, entrances, and the chain that builds them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import measures, places, trails
from ..sources import views as V
from .common import POLY, PT, SNAP, X, Y, near
from .networks import _TRAILS, _named_segments, _segment_layer

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


@query("SELECT p_partkey AS \"buildingId\", CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_name END AS name, CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS kind FROM part")
def tile_properties(spark, sf):
    rows = V.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 5 != 0, F.col("p_name")).alias("name"), "p_size")
    return places.tile_properties(rows, F.when(F.col("p_size") > 25, "large").otherwise("small"))


@query(f"WITH {SNAP} SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.size <= 25 THEN a.brand || ',' || a.type ELSE b.type END AS categories FROM bef b FULL JOIN aft a ON a.id = b.id")
def first_categories(spark, sf):
    none = F.array().cast("array<string>")
    b = V.snapshot(spark, sf, "before").select("id", F.array("type").alias("old"))
    a = V.snapshot(spark, sf, "after").select("id", F.when(F.col("size") <= 25, F.array("brand", "type")).otherwise(none).alias("new"))
    return b.join(a, "id", "full").select("id", F.array_join(places.first_categories(F.col("new"), F.col("old")), ",").alias("categories"))


@query("SELECT c_custkey AS id FROM customer WHERE c_custkey % 3 > 0 AND (c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE') OR c_acctbal < 0)")
def background(spark, sf):
    rows = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("slug"), (F.col("c_custkey") % 3).alias("n"), F.when(F.col("c_acctbal") < 0, " \t").otherwise(F.col("c_name")).alias("name"))
    return places.background(rows, ["BUILDING", "AUTOMOBILE"]).select("id")


@query(f"WITH {POLY} SELECT poly.id, ring, seq, round(x, 7) AS x, round(y, 7) AS y FROM poly JOIN supplier ON s_suppkey = id WHERE s_acctbal > 0")
def category_shapes(spark, sf):
    """Outlines of the areas of one category."""
    rows = V.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.array(F.lit("hall"), F.when(F.col("s_acctbal") > 0, "open").otherwise("closed")).alias("categories"))
    shapes = V.polygons(spark, sf).join(places.of_category(rows, "open").select("id"), "id")
    return shapes.select("id", "ring", "seq", F.round("x", 7).alias("x"), F.round("y", 7).alias("y"))


@query("""SELECT p_partkey AS id, starts_with(regexp_replace(lower(CASE WHEN p_partkey % 2 = 0 THEN p_name || ' West' ELSE p_brand || ' ' || p_name END), '[^a-z0-9]+', '', 'g'), regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g')) AS named FROM part""")
def label_match(spark, sf):
    label = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("(New) "), "p_name", F.lit(" West"))).otherwise(F.concat("p_brand", F.lit(" "), "p_name"))
    return V.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), places.named_first(label, F.col("p_name")).alias("named"))


@query("SELECT l_suppkey AS place, array_to_string(list_sort(list(DISTINCT l_partkey % 40)), ',') AS nodes FROM lineitem GROUP BY 1")
def place_entrances(spark, sf):
    rows = V.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("place"), (F.col("l_partkey") % 40).alias("node"))
    return places.entrances_of(rows).select("place", F.array_join(F.transform("nodes", lambda n: n.cast("string")), ",").alias("nodes"))


@query("SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT -s_suppkey - 1, s_name FROM supplier")
def united(spark, sf):
    a = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    b = V.table(spark, sf, "supplier").select((-F.col("s_suppkey") - 1).alias("id"), F.col("s_name").alias("name"))
    return places.united([a, b])


_OX, _OY = X.format(k="o_orderkey"), Y.format(k="o_orderkey")


@query(f"WITH {PT}, an AS (SELECT o_custkey AS id, arg_max({_OX}, o_orderkey) AS x, arg_max({_OY}, o_orderkey) AS y FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) SELECT pt.id, round(coalesce(an.x, pt.x), 6) AS x, round(coalesce(an.y, pt.y), 6) AS y FROM pt LEFT JOIN an USING (id)")
def anchor_patches(spark, sf):
    k = F.col("o_orderkey")
    given = V.table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id"), V.place_x(k).alias("x"), V.place_y(k).alias("y"), k.alias("pos"))
    return places.anchored(V.points(spark, sf).select("id", "x", "y"), given).select("id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


_SLUG = "regexp_replace(lower(name), '[^a-z0-9]+', '', 'g')"


@query(f"""WITH {PT}, {POLY}, {_TRAILS}, gone AS (SELECT DISTINCT c_mktsegment AS kind, c_name AS name FROM customer WHERE c_acctbal < -900),
piece AS (SELECT v.* FROM vert v LEFT JOIN near n USING (trail, nth) WHERE v.side IS NULL OR (n.m <= 5 AND ((v.side = 'until' AND v.seq <= n.at) OR (v.side = 'from' AND v.seq >= n.at)))),
tr AS (SELECT 'Trail ' || trail AS name, x, y FROM (SELECT *, row_number() OVER (PARTITION BY trail ORDER BY nth, part, seq) - 1 AS rn, count(*) OVER (PARTITION BY trail) AS n FROM piece) WHERE rn = n // 2),
p AS (SELECT pt.id AS k, CASE WHEN nation = 11 THEN 'pin' || pt.id ELSE {_SLUG} END AS id, name, x, y, nation, c_acctbal > 0 AS walk FROM pt JOIN customer ON c_custkey = pt.id WHERE pt.id % 6 <> 0 AND (kind, name) NOT IN (SELECT kind, name FROM gone)
 UNION ALL SELECT NULL, 'customer' || {_SLUG}, name, x, y, NULL, true FROM tr),
{near(500, "p").replace("near AS (", "close AS (")}, par AS (SELECT id, arg_min(fid, (m, fid)) AS parent FROM close GROUP BY id), own AS (SELECT id AS parent, min(name) AS owner FROM poly GROUP BY id),
a AS (SELECT p.id, CASE WHEN nation = 5 THEN 'House ' || p.k ELSE name END AS name, x + CASE WHEN nation = 7 THEN 0.001e0 ELSE 0e0 END AS x, y, CASE WHEN nation = 13 THEN (SELECT min(s_suppkey) FROM supplier) ELSE parent END AS parent, walk, nation FROM p LEFT JOIN par USING (id) WHERE nation IS NULL OR nation <> 3
 UNION ALL SELECT 'part' || n_nationkey, n_name, -93.2e0, 44.4e0, NULL, true, NULL FROM nation
 UNION ALL SELECT 'new' || s_suppkey, s_name, {X.format(k="s_suppkey")}, {Y.format(k="s_suppkey")}, NULL, false, NULL FROM supplier WHERE s_nationkey = 1)
SELECT a.id, a.name || CASE WHEN owner IS NULL THEN '' ELSE ', ' || owner END AS name, round(x, 6) AS x, round(y, 6) AS y, a.parent, CASE WHEN walk THEN 'no fires|' || CASE WHEN nation = 9 THEN 'boats' ELSE 'no boats' END ELSE '' END AS rules,
  CASE WHEN walk AND nation = 15 THEN 'guide' END AS walk, CASE WHEN nation % 10 = 2 THEN n_name || '|attic' END AS floors FROM a LEFT JOIN own USING (parent) LEFT JOIN nation ON n_nationkey = nation""")
def built_places(spark, sf):
    """The whole chain over all customers and trails, with corrections by nation."""
    links = F.array().cast("array<struct<label:string,href:string>>")
    walk = F.when(F.col("c_acctbal") > 0, F.array(F.lit("walk"))).otherwise(F.array(F.lit("spot")))
    customer, k = V.table(spark, sf, "customer"), F.col("c_custkey")
    features = customer.select(F.col("c_mktsegment").alias("slug"), k.alias("pos"), F.when(k % 6 == 0, " ").otherwise(F.col("c_name")).alias("name"), V.place_x(k).alias("x"), V.place_y(k).alias("y"), walk.alias("categories"), links.alias("links"))
    ident = customer.select(places.slug(F.col("c_name")).alias("id"), "c_nationkey", k)
    of = lambda n: ident.where(F.col("c_nationkey") == n)
    areas = measures.segments(V.polygons(spark, sf), ["id", "ring"], ("name",)).withColumnsRenamed({"id": "fid", "name": "owner"})
    new = V.table(spark, sf, "supplier").where("s_nationkey = 1").select(F.concat(F.lit("new"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("name"), V.place_x(F.col("s_suppkey")).alias("x"), V.place_y(F.col("s_suppkey")).alias("y"), F.array(F.lit("spot")).alias("categories"), links.alias("links"))
    by_id = lambda c: ident.select("id", F.col("c_custkey"), F.col("c_nationkey")).where(c)
    pins = customer.where("c_nationkey = 11").select(F.col("c_mktsegment").alias("slug"), F.col("c_name").alias("name"), k.alias("pos"), F.concat(F.lit("pin"), k.cast("string")).alias("id"))
    owner = V.table(spark, sf, "supplier").agg(F.min("s_suppkey").alias("s_suppkey")).first()[0]
    trail_rows = places.trail_features(trails.trail_pieces(_segment_layer(spark, sf), _named_segments(spark, sf)).withColumn("trail", F.concat(F.lit("Trail "), F.col("trail").cast("string"))), "trails", ["trail", "walk"])
    plans = V.table(spark, sf, "nation").select(F.concat(F.lit("/plan/"), F.col("n_nationkey").cast("string")).alias("href"), F.array(F.col("n_name"), F.lit("attic")).alias("floors")).where("href like '%2'")
    pages = F.array(F.struct(F.lit("none").alias("label"), F.lit("/other").alias("href")), F.struct(F.lit("plan").alias("label"), F.concat(F.lit("/plan/"), F.col("c_nationkey").cast("string")).alias("href")))
    features = features.join(customer.select(k.alias("pos"), pages.alias("own_links")), "pos").withColumn("links", F.col("own_links")).drop("own_links")
    got = places.built(
        features,
        superseded=customer.where("c_acctbal < -900").select(F.col("c_mktsegment").alias("slug"), F.col("c_name").alias("name")),
        areas=areas,
        reach_m=500.0,
        prefix="customer",
        removed=of(3),
        patches=of(5).select("id", F.lit("name").alias("field"), F.concat(F.lit("House "), k.cast("string")).alias("value"), F.lit(1).alias("pos")),
        anchors=of(7).select("id", (V.place_x(k) + 0.001).alias("x"), V.place_y(k).alias("y"), F.lit(1).alias("pos")),
        additions=new,
        rules={"categories": ["walk"], "shared": ["no fires", "no boats"], "swaps": of(9).select("id", F.lit("no boats").alias("rule"), F.lit("boats").alias("instead")).distinct(), "link": ("Rules", "https://rules")},
        trails=trail_rows,
        pinned=pins,
        parts=V.table(spark, sf, "nation").select(F.concat(F.lit("part"), F.col("n_nationkey").cast("string")).alias("id"), F.col("n_name").alias("name"), F.lit(-93.2).alias("x"), F.lit(44.4).alias("y"), F.array(F.lit("walk")).alias("categories"), links.alias("links")),
        parents=by_id("c_nationkey = 13").select("id", F.lit(owner).alias("parent")).distinct(),
        walks=(by_id("c_nationkey = 15").select(F.col("id").alias("target"), F.lit("guide").alias("value")).distinct(), "walk"),
        floors=plans,
    )
    return got.select("id", "name", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "parent", F.array_join("rules", "|").alias("rules"), "walk", F.array_join("floors", "|").alias("floors"))
