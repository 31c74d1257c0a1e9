"""Registered queries: ingest, cleaning, projections, filters, ids and overrides."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import conflate, graph, measures, places
from ..sources import views as V
from .common import LINE, PT, SNAP

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


@query("SELECT 'customer' AS layer, c_custkey AS id, c_name AS name, NULL::VARCHAR AS brand FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier UNION ALL SELECT 'part', p_partkey, p_name, p_brand FROM part")
def union_layers(spark, sf):
    return conflate.union_layers({
        "customer": V.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
        "supplier": V.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")),
        "part": V.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand")),
    }, "layer")


@query("SELECT n_name AS source, count(s_suppkey) AS features, count(s_suppkey) = 0 AS empty FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_acctbal > 9000 GROUP BY n_name")
def manifest(spark, sf):
    features = V.table(spark, sf, "supplier").where("s_acctbal > 9000").join(F.broadcast(V.table(spark, sf, "nation")), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("source"))
    return conflate.manifest(V.table(spark, sf, "nation").select(F.col("n_name").alias("source")), features, "source")


@query(f"WITH {SNAP} SELECT 'before' AS snapshot_id, id, name, brand FROM bef")
def snapshot_read(spark, sf):
    both = [V.snapshot(spark, sf, v).select(F.lit(v).alias("snapshot_id"), "id", "name", "brand") for v in ("before", "after")]
    return conflate.read_version(both[0].unionByName(both[1]), "before")


@query(f"""WITH {SNAP}, d AS ((SELECT brand, name, size FROM bef EXCEPT ALL SELECT brand, name, size FROM aft) UNION ALL (SELECT brand, name, size FROM aft EXCEPT ALL SELECT brand, name, size FROM bef))
SELECT brand AS layer, count(*) AS differing FROM d GROUP BY brand""")
def drift(spark, sf):
    a, b = (V.snapshot(spark, sf, v).select(F.col("brand").alias("layer"), "name", "size") for v in ("before", "after"))
    return conflate.drift(a, b, "layer")


@query(f"WITH {SNAP} SELECT gained, lost, gained + lost > 0 AS publish FROM (SELECT count(*) AS gained FROM (SELECT id, name FROM aft EXCEPT ALL SELECT id, name FROM bef)), (SELECT count(*) AS lost FROM (SELECT id, name FROM bef EXCEPT ALL SELECT id, name FROM aft))")
def change_gate(spark, sf):
    a, b = (V.snapshot(spark, sf, v).select("id", "name") for v in ("before", "after"))
    gained, lost = b.exceptAll(a).withColumn("k", F.lit("gained")), a.exceptAll(b).withColumn("k", F.lit("lost"))
    return gained.unionByName(lost).agg(F.count_if(F.col("k") == "gained").alias("gained"), F.count_if(F.col("k") == "lost").alias("lost")).withColumn("publish", F.col("gained") + F.col("lost") > 0)


@query("SELECT p_partkey AS id, nullif(trim(CASE WHEN p_partkey % 5 = 0 THEN '  ' ELSE ' ' || p_name || ' ' END), '') AS name FROM part")
def clean_names(spark, sf):
    raw = F.when(F.col("p_partkey") % 5 == 0, "  ").otherwise(F.concat(F.lit(" "), "p_name", F.lit(" ")))
    return V.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), S.blank_to_null(raw).alias("name"))


@query(f"WITH {PT} SELECT id, round(x + id*1.23456e-9, 7) AS x, round(y - id*1.23456e-9, 7) AS y FROM pt")
def round_coords(spark, sf):
    return V.points(spark, sf).select("id", F.bround(F.col("x") + F.col("id") * F.lit(1.23456e-9), 7).alias("x"), F.bround(F.col("y") - F.col("id") * F.lit(1.23456e-9), 7).alias("y"))


@query("SELECT p_partkey AS id, coalesce(nullif(trim(CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_name END), ''), nullif(trim(CASE WHEN p_partkey % 2 = 0 THEN ' ' ELSE p_brand END), ''), 'Unnamed') AS name FROM part")
def name_coalesce(spark, sf):
    k = F.col("p_partkey")
    return V.table(spark, sf, "part").select(k.alias("id"), S.first_name(F.when(k % 3 == 0, "").otherwise(F.col("p_name")), F.when(k % 2 == 0, " ").otherwise(F.col("p_brand")), fallback="Unnamed").alias("name"))


@query("""WITH c AS (SELECT p_partkey AS id, CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS a, replace(trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '_', 'g'), '_'), '_', '-') AS b FROM part)
SELECT id, 'part,' || a || CASE WHEN b IS NULL OR b IN (a, 'part') THEN '' ELSE ',' || b END AS categories FROM c""")
def categories(spark, sf):
    return V.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.array_join(F.array_distinct(F.array_compact(F.array(F.lit("part"), F.when(F.col("p_size") > 25, "large").otherwise("small"), S.hyphenated(F.col("p_type"))))), ",").alias("categories"))


@query(f"WITH {PT} SELECT id, y AS lat, x AS lon, coalesce(name, '') AS name, coalesce(kind, 'none') AS kind, '' AS description, nation % 2 = 0 AS listed FROM pt")
def record_projection(spark, sf):
    return V.points(spark, sf).select("id", F.col("y").alias("lat"), F.col("x").alias("lon"), F.coalesce("name", F.lit("")).alias("name"), F.coalesce("kind", F.lit("none")).alias("kind"), F.lit("").alias("description"), (F.col("nation") % 2 == 0).alias("listed"))


@query("SELECT page_id, 'Page ' || page_id || ' <' || url || '>|Source <' || url || '#top>' AS links FROM pages")
def links_flat(spark, sf):
    link = lambda label, href: F.struct(label.alias("label"), href.alias("href"))
    links = F.array(link(F.concat(F.lit("Page "), F.col("page_id").cast("string")), F.col("url")), link(F.lit("Source"), F.concat("url", F.lit("#top"))))
    return V.table(spark, sf, "pages").select("page_id", F.array_join(S.links_text(links), "|").alias("links"))


@query("SELECT p_partkey AS id, CASE WHEN regexp_matches(p_type, 'STEEL|COPPER') THEN 'metal' WHEN regexp_matches(p_type, 'BRASS') THEN 'alloy' WHEN p_type LIKE 'STANDARD%' THEN 'plain' ELSE 'other' END AS layer FROM part")
def classify(spark, sf):
    return V.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), S.by_rules(F.col("p_type"), [("STEEL|COPPER", "metal"), ("BRASS", "alloy"), ("^STANDARD", "plain")], "other").alias("layer"))


@query("""SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN 'Rack' ELSE 'Rack, ' || c_name || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ' (' || c_mktsegment || ')' END END AS name FROM customer""")
def templated_name(spark, sf):
    k = F.col("c_custkey")
    return V.table(spark, sf, "customer").select(k.alias("id"), S.templated("Rack", F.when(k % 4 != 0, F.col("c_name")), F.when(k % 3 != 0, F.col("c_mktsegment"))).alias("name"))


@query("""WITH t AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_brand || ' - ' || p_name || ' - ' || p_type END AS label FROM part)
SELECT id, CASE WHEN strpos(label, ' - ') > 0 THEN left(label, strpos(label, ' - ') - 1) ELSE label END AS building, CASE WHEN strpos(label, ' - ') > 0 THEN substr(label, strpos(label, ' - ') + 3) END AS place FROM t""")
def partition_once(spark, sf):
    k = F.col("p_partkey")
    label = F.when(k % 3 == 0, F.col("p_name")).otherwise(F.concat_ws(" - ", "p_brand", "p_name", "p_type"))
    a, b = S.split_once(F.col("label"), " - ")
    return V.table(spark, sf, "part").select(k.alias("id"), label.alias("label")).select("id", a.alias("building"), b.alias("place"))


@query("""WITH c(word, rank) AS (VALUES ('large', 1), ('metal', 2), ('part', 3)), t AS (SELECT p_partkey AS id, p_brand, list_filter(['part', CASE WHEN p_size > 40 THEN 'large' END, CASE WHEN p_partkey % 2 = 0 THEN 'metal' END], lambda x: x IS NOT NULL AND p_partkey % 5 <> 0) AS cats FROM part),
u AS (SELECT id, unnest(cats) AS cat FROM t)
SELECT t.id, coalesce((SELECT arg_min(word, rank) FROM u JOIN c ON cat = word WHERE u.id = t.id), 'place') AS word FROM t""")
def category_word(spark, sf):
    k = F.col("p_partkey")
    cats = F.filter(F.array(F.lit("part"), F.when(F.col("p_size") > 40, "large"), F.when(k % 2 == 0, "metal")), lambda x: x.isNotNull() & (k % 5 != 0))
    return conflate.category_word(V.table(spark, sf, "part").select(k.alias("id"), cats.alias("categories")), ["large", "metal", "part"])


@query(f"""WITH {SNAP} SELECT coalesce(b.id, a.id) AS id, CASE WHEN b.id IS NULL THEN 'added' WHEN a.id IS NULL THEN 'removed' WHEN b.x <> a.x THEN 'moved' WHEN b.name <> a.name THEN 'edited' ELSE 'same' END AS sentence FROM bef b FULL JOIN aft a ON a.id = b.id""")
def sentence_kind(spark, sf):
    b, a = V.snapshot(spark, sf, "before").alias("b"), V.snapshot(spark, sf, "after").alias("a")
    kind = F.when(F.col("b.id").isNull(), "added").when(F.col("a.id").isNull(), "removed").when(F.col("b.x") != F.col("a.x"), "moved").when(F.col("b.name") != F.col("a.name"), "edited").otherwise("same")
    return b.join(a, F.col("a.id") == F.col("b.id"), "full").select(F.coalesce("b.id", "a.id").alias("id"), kind.alias("sentence"))


@query("SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' THEN 'rush' END AS kind FROM orders")
def first_kind(spark, sf):
    known = F.array(F.lit("done"), F.lit("rush"))
    own = F.array(F.when(F.col("o_orderstatus") == "F", "done").otherwise("open"), F.when(F.col("o_orderpriority").rlike("^[12]"), "rush").otherwise("slow"))
    return V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.get(F.filter(own, lambda c: F.array_contains(known, c)), 0).alias("kind"))


@query("""WITH v AS (SELECT o_orderkey AS version, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders), gv AS (SELECT version, date || '-3' AS name FROM v WHERE version % 11 = 0 UNION ALL SELECT -version - 1, date FROM v WHERE version % 13 = 0),
kept AS (SELECT version, min(name) AS name FROM gv GROUP BY 1), op AS (SELECT v.*, row_number() OVER (PARTITION BY date ORDER BY version) AS k FROM v WHERE version NOT IN (SELECT version FROM kept)),
tk AS (SELECT DISTINCT left(name, 10) AS date, CASE WHEN length(name) = 10 THEN 1 ELSE CAST(substr(name, 12) AS INT) END AS n FROM gv), cand AS (SELECT date, unnest(range(1, max(k) + 3)) AS n FROM op GROUP BY date),
fr AS (SELECT date, n, row_number() OVER (PARTITION BY date ORDER BY n) AS k FROM cand WHERE (date, n) NOT IN (SELECT date, n FROM tk))
SELECT v.version, kept.name FROM v JOIN kept USING (version) UNION ALL SELECT op.version, op.date || CASE WHEN fr.n = 1 THEN '' ELSE '-' || fr.n END FROM op JOIN fr ON fr.date = op.date AND fr.k = op.k""")
def release_name(spark, sf):
    versions = V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("version"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))
    own = versions.where("version % 11 = 0").select("version", F.concat("date", F.lit("-3")).alias("name"))
    others = versions.where("version % 13 = 0").select((-F.col("version") - 1).alias("version"), F.col("date").alias("name"))
    return conflate.release_names(versions, own.unionByName(others))


@query("SELECT CAST(c_nationkey AS BIGINT) AS slug, count(*) FILTER (WHERE c_custkey % 6 <> 0) AS named, count(*) FILTER (WHERE c_custkey % 6 = 0) AS dropped FROM customer GROUP BY 1")
def unnamed_split(spark, sf):
    name = S.blank_to_null(F.when(F.col("c_custkey") % 6 == 0, " ").otherwise(F.col("c_name")))
    rows = V.table(spark, sf, "customer").select(F.col("c_nationkey").cast("long").alias("slug"), name.alias("name"))
    return rows.groupBy("slug").agg(F.count("name").alias("named"), F.count_if(F.col("name").isNull()).alias("dropped"))


@query("SELECT p_partkey AS id, p_name AS name FROM part WHERE NOT EXISTS (SELECT 1 FROM part q WHERE q.p_partkey % 9 = 0 AND q.p_brand = part.p_brand AND q.p_name = part.p_name)")
def superseded_anti(spark, sf):
    part = V.table(spark, sf, "part")
    gone = part.where("p_partkey % 9 = 0").select("p_brand", "p_name").distinct()
    return part.join(gone, ["p_brand", "p_name"], "left_anti").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))


@query(f"WITH {PT} SELECT id, x BETWEEN -93.3e0 AND -93.1e0 AND y BETWEEN 44.4e0 AND 44.5e0 AS inside FROM pt")
def bounds_filter(spark, sf):
    return V.points(spark, sf).select("id", (F.col("x").between(-93.3, -93.1) & F.col("y").between(44.4, 44.5)).alias("inside"))


@query("""WITH b AS (SELECT p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g') AS base FROM part), n AS (SELECT *, count(*) OVER (PARTITION BY base) AS n, row_number() OVER (PARTITION BY base ORDER BY p_partkey) AS rn FROM b)
SELECT p_partkey AS pos, 'p_' || base || CASE WHEN n = 1 THEN '' ELSE '-' || rn END AS id FROM n""")
def assign_ids(spark, sf):
    rows = V.table(spark, sf, "part").select(F.col("p_partkey").alias("pos"), F.col("p_name").alias("name"))
    return conflate.assign_ids(rows, "p_", F.col("name")).select("pos", "id")


@query("SELECT p_partkey AS id, regexp_replace(regexp_replace(lower(CASE WHEN p_partkey % 2 = 0 THEN '(' || p_brand || ') ' || p_name ELSE p_name || '!' END), '^\\s*\\([^)]*\\)\\s*', ''), '[^a-z0-9]+', '', 'g') AS slug FROM part")
def slugify(spark, sf):
    k = F.col("p_partkey")
    raw = F.when(k % 2 == 0, F.concat(F.lit("("), "p_brand", F.lit(") "), "p_name")).otherwise(F.concat("p_name", F.lit("!")))
    return V.table(spark, sf, "part").select(k.alias("id"), S.slug(raw).alias("slug"))


@query("""WITH d AS (SELECT s_name AS name, max(s_suppkey) AS id FROM (SELECT 'S' || (s_suppkey % 40) AS s_name, s_suppkey FROM supplier) GROUP BY 1) SELECT c_custkey AS id, d.id AS parent FROM customer LEFT JOIN d ON d.name = 'S' || (c_custkey % 50)""")
def name_lookup(spark, sf):
    known = V.table(spark, sf, "supplier").select(F.concat(F.lit("S"), (F.col("s_suppkey") % 40).cast("string")).alias("name"), F.col("s_suppkey").alias("pos"), F.col("s_suppkey").alias("parent"))
    rows = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("S"), (F.col("c_custkey") % 50).cast("string")).alias("name"))
    return conflate.lookup_last(rows, known, "name", "parent").select("id", "parent")


@query("SELECT c_custkey AS id, n_name || ' / ' || c_name AS name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey")
def parent_name(spark, sf):
    parents = V.table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name"))
    return V.table(spark, sf, "customer").join(parents, "c_nationkey", "left").select(F.col("c_custkey").alias("id"), F.concat("n_name", F.lit(" / "), "c_name").alias("name"))


@query("""WITH r AS (SELECT conv_id, turn, rtrim(coalesce(nullif(regexp_extract('see https://x.org/p' || (conv_id % 300) || CASE WHEN turn % 2 = 0 THEN '/' ELSE '' END || ' now', 'https?://[^ ]+'), ''), ''), '/') AS url FROM conversations)
SELECT r.conv_id, r.turn, p.page_id FROM r LEFT JOIN pages p ON 'https://x.org/p' || p.page_id = r.url""")
def url_lookup(spark, sf):
    prose = F.concat(F.lit("see https://x.org/p"), (F.col("conv_id") % 300).cast("string"), F.when(F.col("turn") % 2 == 0, "/").otherwise(""), F.lit(" now"))
    pages = V.table(spark, sf, "pages").select(F.concat(F.lit("https://x.org/p"), F.col("page_id").cast("string")).alias("url"), "page_id")
    return V.table(spark, sf, "conversations").select("conv_id", "turn", F.rtrim(F.regexp_extract(prose, r"https?://[^ ]+", 0), F.lit("/")).alias("url")).join(pages, "url", "left").select("conv_id", "turn", "page_id")


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49)")
def removals(spark, sf):
    gone = V.table(spark, sf, "lineitem").where("l_quantity > 49").select(F.col("l_orderkey").alias("id")).distinct()
    return V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id")).join(gone, "id", "left_anti")


@query("""WITH f AS (SELECT o_custkey AS id, o_orderkey % 2 AS field, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS value, row_number() OVER (PARTITION BY o_custkey, o_orderkey % 2 ORDER BY o_orderkey DESC) AS rn FROM orders WHERE o_orderkey % 3 = 0)
SELECT c.c_custkey AS id, CASE WHEN n.id IS NOT NULL THEN n.value ELSE c.c_name END AS name, CASE WHEN k.id IS NOT NULL THEN k.value ELSE c.c_mktsegment END AS kind
FROM customer c LEFT JOIN f n ON n.id = c.c_custkey AND n.field = 0 AND n.rn = 1 LEFT JOIN f k ON k.id = c.c_custkey AND k.field = 1 AND k.rn = 1""")
def patches(spark, sf):
    rows = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("kind"))
    k = F.col("o_orderkey")
    spec = V.table(spark, sf, "orders").where(k % 3 == 0).select(F.col("o_custkey").alias("id"), F.when(k % 2 == 0, "name").otherwise("kind").alias("field"), F.when(k % 5 != 0, F.col("o_orderpriority")).alias("value"), k.alias("pos"))
    return conflate.patched(rows, spec, ["name", "kind"])


@query("""SELECT p_partkey AS id, CASE WHEN p_size > 20 THEN 'no fires|' || CASE WHEN p_size > 30 THEN p_brand ELSE 'no boats' END ELSE '' END AS rules, CASE WHEN p_size > 20 OR p_partkey % 2 = 0 THEN 1 ELSE 0 END AS links FROM part""")
def apply_rules(spark, sf):
    k, link = F.col("p_partkey"), F.array(F.struct(F.lit("Rules").alias("label"), F.lit("https://rules").alias("href")))
    part = V.table(spark, sf, "part")
    rows = part.select(k.alias("id"), F.array(F.when(F.col("p_size") > 20, "large").otherwise("small")).alias("categories"), F.when(k % 2 == 0, link).otherwise(F.slice(link, 1, 0)).alias("links"))
    swaps = part.where("p_size > 30").select(k.alias("id"), F.lit("no boats").alias("rule"), F.col("p_brand").alias("instead"))
    got = places.ruled(rows, ["large", "huge"], ["no fires", "no boats"], swaps, ("Rules", "https://rules"))
    return got.select("id", F.array_join("rules", "|").alias("rules"), F.size("links").alias("links"))


@query("SELECT p_name AS name, max(p_partkey) AS last_id, count(DISTINCT p_brand) > 1 AS brand_differs, count(DISTINCT p_type) > 1 AS type_differs, count(DISTINCT p_size) > 1 AS size_differs FROM part GROUP BY p_name HAVING count(*) > 1")
def piece_conflicts(spark, sf):
    fields = {"brand": "p_brand", "type": "p_type", "size": "p_size"}
    return V.table(spark, sf, "part").groupBy(F.col("p_name").alias("name")).agg(F.count(F.lit(1)).alias("n"), F.max("p_partkey").alias("last_id"), *[(F.count_distinct(c) > 1).alias(f"{n}_differs") for n, c in fields.items()]).where("n > 1").drop("n")


@query("SELECT p_name AS name, count(*) AS n FROM part GROUP BY p_name HAVING count(*) > 1")
def duplicates(spark, sf):
    return V.table(spark, sf, "part").groupBy(F.col("p_name").alias("name")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("SELECT count(*) AS places, count(*) FILTER (WHERE c_acctbal > 0) AS with_footprint, count(*) FILTER (WHERE c_custkey % 6 = 0) AS dropped FROM customer")
def coverage_counts(spark, sf):
    return V.table(spark, sf, "customer").agg(F.count(F.lit(1)).alias("places"), F.count_if(F.col("c_acctbal") > 0).alias("with_footprint"), F.count_if(F.col("c_custkey") % 6 == 0).alias("dropped"))


@query("WITH t(layer, least) AS (VALUES ('1-URGENT', 1000), ('2-HIGH', 4000), ('5-LOW', 100), ('NONE', 1)) SELECT layer, CAST(least AS BIGINT) AS least, count(o_orderkey) AS found FROM t LEFT JOIN orders ON o_orderpriority = layer GROUP BY ALL HAVING count(o_orderkey) < least")
def floors_check(spark, sf):
    least = spark.createDataFrame([("1-URGENT", 1000), ("2-HIGH", 4000), ("5-LOW", 100), ("NONE", 1)], "layer string, least long")
    n = V.table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("layer")).agg(F.count(F.lit(1)).alias("found"))
    return F.broadcast(least).join(n, "layer", "left").select("layer", "least", F.coalesce("found", F.lit(0)).alias("found")).where("found < least")


@query("""WITH t AS (SELECT conv_id, turn, text, string_split(text, chr(10)) AS ls FROM conversations), u AS (SELECT conv_id, turn, unnest(range(len(ls))) AS i, unnest(ls) AS l FROM t), h AS (SELECT *, last_value(CASE WHEN length(l) % 7 = 0 THEN l END IGNORE NULLS) OVER (PARTITION BY conv_id, turn ORDER BY i) AS section FROM u)
SELECT conv_id, turn, CAST(i AS BIGINT) AS i, section FROM h WHERE length(l) % 7 <> 0""")
def sections(spark, sf):
    w = Window.partitionBy("conv_id", "turn").orderBy("i")
    rows = V.table(spark, sf, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("i", "l"))
    head = F.length("l") % 7 == 0
    return rows.withColumn("section", F.last(F.when(head, F.col("l")), ignorenulls=True).over(w)).where(~head).select("conv_id", "turn", F.col("i").cast("long").alias("i"), "section")


_HAV = "2*6371008.8e0*asin(sqrt(power(sin((radians(y1) - radians(y0))/2), 2) + cos(radians(y0))*cos(radians(y1))*power(sin(radians(x1 - x0)/2), 2)))"


@query(f"""WITH {LINE}, p AS (SELECT *, line % 500 AS trail, dense_rank() OVER (PARTITION BY line % 500 ORDER BY line) - 1 AS part FROM lv), w AS (SELECT trail, trail % 3 AS part FROM p GROUP BY trail), k AS (SELECT DISTINCT p.trail, p.line FROM p JOIN w USING (trail, part))
SELECT 'trail' || k.trail || 'part' AS id, (SELECT count(*) FROM lv WHERE lv.line = k.line) AS vertices, coalesce((SELECT round(sum({_HAV}), 2) FROM lseg WHERE lseg.line = k.line), 0) AS metres FROM k""")
def part_as_row(spark, sf):
    """One part of each trail as a row of its own: the first, second or third of its lines."""
    v = V.line_vertices(spark, sf).withColumn("trail", F.col("line") % 500)
    # lines are numbered apart from their vertices
    part = F.dense_rank().over(Window.partitionBy("trail").orderBy("line")) - 1
    numbers = v.select("trail", "line").distinct().withColumn("part", part)
    wanted = numbers.select("trail").distinct().select("trail", (F.col("trail") % 3).cast("int").alias("part"), F.concat(F.lit("trail"), F.col("trail").cast("string"), F.lit("part")).alias("id"))
    rows = graph.part_rows(v.join(numbers, ["trail", "line"]), wanted)
    n = rows.groupBy("id").agg(F.count(F.lit(1)).alias("vertices"))
    return n.join(measures.lengths(rows, ["id"]), "id", "left").select("id", "vertices", F.coalesce(F.round("metres", 2), F.lit(0.0)).alias("metres"))
