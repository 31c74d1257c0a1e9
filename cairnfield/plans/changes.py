"""Registered queries: change detection between two versions, areas and summaries of change, change feed."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import diff, places
from ..operators.ranks import ranked
from ..sources import views as V
from ..streaming.feed import changed_versions
from .common import CTX, SNAP, metres

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


FIELDS = ["name", "type", "brand", "size"]
_DIFF = f"""{SNAP}, df AS (SELECT coalesce(b.id, a.id) AS id, coalesce(b.name, a.name) AS name, coalesce(b.brand, a.brand) AS brand, CASE WHEN b.id IS NULL THEN 'added' WHEN a.id IS NULL THEN 'removed'
 WHEN b.name IS NOT DISTINCT FROM a.name AND b.type IS NOT DISTINCT FROM a.type AND b.brand IS NOT DISTINCT FROM a.brand AND b.size IS NOT DISTINCT FROM a.size THEN 'same' ELSE 'changed' END AS kind FROM bef b FULL JOIN aft a ON a.id = b.id)"""


def _versions(spark, sf):
    return V.snapshot(spark, sf, "before"), V.snapshot(spark, sf, "after")


def _kinds(spark, sf):
    b, a = _versions(spark, sf)
    return diff.keyed_diff(b, a, "id", FIELDS)


def _named_kinds(spark, sf):
    b, a = _versions(spark, sf)
    return diff.keyed_diff(b, a, "id", FIELDS, ("name", "brand"))


@query(f"WITH {_DIFF} SELECT id, kind FROM df")
def snapshot_diff(spark, sf):
    return _kinds(spark, sf)


@query(f"""WITH {SNAP}, u AS (SELECT b.id, unnest(['name', 'type', 'brand', 'size']) AS field, unnest([b.name, b.type, b.brand, CAST(b.size AS VARCHAR)]) AS old, unnest([a.name, a.type, a.brand, CAST(a.size AS VARCHAR)]) AS new FROM bef b JOIN aft a ON a.id = b.id)
SELECT * FROM u WHERE old IS DISTINCT FROM new""")
def field_diff(spark, sf):
    return diff.field_diff(*_versions(spark, sf), "id", FIELDS)


@query(f"WITH {CTX}, d AS (SELECT slug, shape, sum(n) AS n FROM (SELECT slug, shape, -1 AS n FROM cb UNION ALL SELECT slug, shape, 1 FROM ca) GROUP BY ALL HAVING sum(n) <> 0) SELECT slug, shape, CASE WHEN n > 0 THEN 'added' ELSE 'removed' END AS side, CAST(abs(n) AS BIGINT) AS n FROM d")
def multiset_diff(spark, sf):
    return diff.multiset_diff(V.context(spark, sf, "before"), V.context(spark, sf, "after"))


@query(f"WITH {CTX}, d AS (SELECT slug, shape, sum(n) AS n FROM (SELECT slug, shape, -1 AS n FROM cb UNION ALL SELECT slug, shape, 1 FROM ca) GROUP BY ALL) SELECT slug, CAST(sum(greatest(n, 0)) AS BIGINT) AS added, CAST(sum(greatest(-n, 0)) AS BIGINT) AS removed FROM d GROUP BY slug")
def context_counts(spark, sf):
    d = diff.multiset_diff(V.context(spark, sf, "before"), V.context(spark, sf, "after"))
    return d.groupBy("slug").agg(F.coalesce(F.sum(F.when(F.col("side") == "added", F.col("n"))), F.lit(0)).alias("added"), F.coalesce(F.sum(F.when(F.col("side") == "removed", F.col("n"))), F.lit(0)).alias("removed"))


_RENAME = f"""old AS (SELECT row_number() OVER (ORDER BY b.id) AS rn, b.id, b.brand, b.x, b.y FROM bef b WHERE b.id NOT IN (SELECT id FROM aft)), new AS (SELECT id, brand, x, y FROM aft WHERE id NOT IN (SELECT id FROM bef)),
cand AS (SELECT o.rn, o.id AS old, n.id AS new, {metres('o.', 'n.')} AS m FROM old o JOIN new n ON o.brand = n.brand AND {metres('o.', 'n.')} <= 400),
go(rn, taken, old, new, m) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE) UNION ALL
 SELECT g.rn + 1, CASE WHEN p.new IS NULL THEN g.taken ELSE list_append(g.taken, p.new) END, p.old, p.new, p.m FROM go g LEFT JOIN LATERAL (SELECT c.old, c.new, c.m FROM cand c WHERE c.rn = g.rn + 1 AND NOT list_contains(g.taken, c.new) ORDER BY c.m, c.new LIMIT 1) p ON TRUE WHERE g.rn < (SELECT max(rn) FROM old))"""


@query(f"WITH RECURSIVE {SNAP}, {_RENAME} SELECT old, new, round(m, 2) AS metres FROM go WHERE new IS NOT NULL")
def rename_pairs(spark, sf):
    b, a = (df.select("id", F.col("brand").alias("kind"), "x", "y") for df in _versions(spark, sf))
    return diff.paired_renames(b.join(a.select("id"), "id", "left_anti"), a.join(b.select("id"), "id", "left_anti"), 400.0).select("old", "new", F.round("m", 2).alias("metres"))


@query(f"WITH {_DIFF} SELECT kind, brand, count(*) AS n, CASE WHEN count(*) > 10 THEN NULL WHEN count(*) > 3 THEN array_to_string(list_sort(list(name))[1:3], ', ') || ' and ' || (count(*) - 3) || ' more' ELSE array_to_string(list_sort(list(name)), ', ') END AS names FROM df WHERE kind <> 'same' GROUP BY kind, brand")
def change_summary(spark, sf):
    return diff.summarised(_named_kinds(spark, sf).where("kind <> 'same'"), ["kind", "brand"], "name")


@query(f"WITH {_DIFF} SELECT k.kind, count(df.id) AS n FROM (VALUES ('added'), ('removed'), ('changed'), ('renamed')) k(kind) LEFT JOIN df ON df.kind = k.kind GROUP BY k.kind")
def change_counts(spark, sf):
    kinds = F.explode(F.array(*[F.lit(k) for k in ("added", "removed", "changed", "renamed")])).alias("kind")
    n = _kinds(spark, sf).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    return spark.range(1).select(kinds).join(n, "kind", "left").select("kind", F.coalesce("n", F.lit(0)).alias("n"))


@query(f"WITH {SNAP} (SELECT id, 'removed' AS side FROM bef WHERE id NOT IN (SELECT id FROM aft)) UNION ALL (SELECT id, 'added' FROM aft WHERE id NOT IN (SELECT id FROM bef))")
def id_diff(spark, sf):
    b, a = (df.select("id") for df in _versions(spark, sf))
    return b.join(a, "id", "left_anti").withColumn("side", F.lit("removed")).unionByName(a.join(b, "id", "left_anti").withColumn("side", F.lit("added")))


_W = "string_split_regex(text, '\\s+')"
_TURNS = "t AS (SELECT conv_id, turn, lag(text) OVER (PARTITION BY conv_id ORDER BY turn, text) AS bt, text AS nt FROM conversations), tp AS (SELECT * FROM t WHERE bt IS NOT NULL)"


def _turns(spark, sf):
    w = Window.partitionBy("conv_id").orderBy("turn", "text")
    rows = diff.in_even_parts(V.table(spark, sf, "conversations").select("conv_id", "turn", "text"), "conv_id", "text")
    return rows.select("conv_id", "turn", F.lag("text").over(w).alias("before"), F.col("text").alias("after")).where("before is not null")


@query(f"""WITH {_TURNS}, w AS (SELECT conv_id, turn, unnest(string_split_regex(bt, '\\s+')) AS word, -1 AS n FROM tp UNION ALL SELECT conv_id, turn, unnest(string_split_regex(nt, '\\s+')), 1 FROM tp)
SELECT conv_id, turn, word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE word <> '' GROUP BY ALL HAVING sum(n) <> 0""")
def word_bag_diff(spark, sf):
    return diff.word_bag_diff(_turns(spark, sf), ["conv_id", "turn"], "before", "after")


@query()
def word_diff(spark, sf):
    return diff.word_diff(_turns(spark, sf), ["conv_id", "turn"], "before", "after")


@query(f"""WITH {_TURNS}, w AS (SELECT conv_id, turn, unnest(string_split(bt, chr(10))) AS item, -1 AS n FROM tp UNION ALL SELECT conv_id, turn, unnest(string_split(nt, chr(10))), 1 FROM tp), d AS (SELECT conv_id, turn, item, sum(n) AS n FROM w GROUP BY ALL)
SELECT conv_id, turn, CAST(sum(greatest(n, 0)) AS BIGINT) AS added, CAST(sum(greatest(-n, 0)) AS BIGINT) AS removed, sum(abs(n)) = 0 AS reordered_only FROM d GROUP BY ALL""")
def list_diff(spark, sf):
    rows = _turns(spark, sf)
    items = lambda c, n: rows.select("conv_id", "turn", F.explode(F.split(c, "\n")).alias("item"), F.lit(n).alias("n"))
    d = items("before", -1).unionByName(items("after", 1)).groupBy("conv_id", "turn", "item").agg(F.sum("n").alias("n"))
    return d.groupBy("conv_id", "turn").agg(F.sum(F.greatest(F.col("n"), F.lit(0))).alias("added"), F.sum(F.greatest(-F.col("n"), F.lit(0))).alias("removed"), (F.sum(F.abs("n")) == 0).alias("reordered_only"))


@query("""WITH m AS (SELECT o_custkey AS id, o_orderpriority AS k, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS old, count(*) FILTER (WHERE o_orderkey % 2 = 1) AS new FROM orders GROUP BY ALL)
SELECT id, k AS entry, CASE WHEN old > 0 THEN old END AS old, CASE WHEN new > 0 THEN new END AS new FROM m WHERE old <> new""")
def map_diff(spark, sf):
    base = V.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id"), (F.col("o_orderkey") % 2).alias("v"), F.col("o_orderpriority").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    maps = base.groupBy("id").agg(F.map_from_entries(F.collect_list(F.when(F.col("v") == 0, F.struct("k", "n")))).alias("a"), F.map_from_entries(F.collect_list(F.when(F.col("v") == 1, F.struct("k", "n")))).alias("b"))
    keys = F.explode(F.array_union(F.map_keys("a"), F.map_keys("b"))).alias("entry")
    return maps.select("id", "a", "b", keys).select("id", "entry", F.try_element_at("a", F.col("entry")).alias("old"), F.try_element_at("b", F.col("entry")).alias("new")).where("not (old <=> new)")


@query("SELECT key, event_id, v AS value, previous FROM (SELECT user_id AS key, event_id, event_type AS v, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events) WHERE previous IS NULL OR previous <> v")
def change_feed(spark, sf):
    return changed_versions(V.feed(spark, sf))


_AREAS = f"""{SNAP}, ch AS (SELECT coalesce(a.id, b.id) AS id, CASE WHEN b.id IS NULL THEN 'added' WHEN a.id IS NULL THEN 'removed' ELSE 'moved' END AS kind, coalesce(a.x, b.x) AS x, coalesce(a.y, b.y) AS y, CASE WHEN a.x <> b.x OR a.y <> b.y THEN {metres('b.', 'a.')} END AS metres FROM bef b FULL JOIN aft a ON a.id = b.id WHERE a.id IS NULL OR b.id IS NULL OR a.x <> b.x OR a.y <> b.y),
nl AS (SELECT count(*) > 20 AS new_layer, min(id) AS first FROM ch WHERE kind = 'added'), rest AS (SELECT ch.* FROM ch, nl WHERE NOT (new_layer AND kind = 'added')),
e AS (SELECT a.id AS a, b.id AS b FROM rest a JOIN rest b ON a.id < b.id WHERE {metres('a.', 'b.')} <= 300), bo AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(node, root) AS (SELECT id, id FROM rest UNION SELECT bo.b, r.root FROM r JOIN bo ON bo.a = r.node), ar AS (SELECT node AS id, min(root) AS area FROM r GROUP BY node UNION ALL SELECT id, first FROM ch, nl WHERE new_layer AND kind = 'added'),
fa AS (SELECT area, count(*) AS places, count(*) FILTER (WHERE kind = 'added') AS added, count(*) FILTER (WHERE kind = 'removed') AS removed, count(*) FILTER (WHERE kind = 'moved') AS moved, max(metres) AS most_m, max(y) AS north, arg_max(x, (y, -x)) AS west FROM ar JOIN ch USING (id) GROUP BY area)"""


def _changed_places(spark, sf):
    """Places that were added, removed or moved between the two versions, where they are now or were last."""
    b, a = (df.select("id", F.col("x").alias(f"{n}x"), F.col("y").alias(f"{n}y")) for df, n in zip(_versions(spark, sf), "ba", strict=True))
    both = b.join(a, "id", "full").withColumn("kind", F.when(F.col("bx").isNull(), "added").when(F.col("ax").isNull(), "removed").otherwise("moved"))
    off = F.when((F.col("ax") != F.col("bx")) | (F.col("ay") != F.col("by")), geo.metres(F.col("bx"), F.col("by"), F.col("ax"), F.col("ay")))
    rows = both.select("id", "kind", F.coalesce("ax", "bx").alias("x"), F.coalesce("ay", "by").alias("y"), off.alias("metres"))
    return rows.where("kind <> 'moved' or metres is not null")


def _areas(spark, sf):
    return diff.change_areas(_changed_places(spark, sf), 300.0)


@query(f"WITH RECURSIVE {_AREAS} SELECT id, area FROM ar")
def areas(spark, sf):
    return _areas(spark, sf).select("id", "area")


@query(f"WITH RECURSIVE {_AREAS} SELECT area, places, added, removed, moved, round(most_m, 2) AS most_m, round(north, 6) AS north, round(west, 6) AS west FROM fa")
def area_facts(spark, sf):
    return diff.area_facts(_areas(spark, sf)).withColumns({"most_m": F.round("most_m", 2), "north": F.round("north", 6), "west": F.round("west", 6)})


@query(f"WITH RECURSIVE {_AREAS} SELECT area, row_number() OVER (ORDER BY north DESC, west, area) AS rank FROM fa")
def area_order(spark, sf):
    facts = diff.area_facts(_areas(spark, sf))
    return ranked(facts, [F.desc("north"), F.asc("west"), F.asc("area")]).select("area", "rank")


@query(f"WITH RECURSIVE {_AREAS}, o AS (SELECT *, row_number() OVER (ORDER BY north DESC, west, area) AS rank, count(*) OVER () AS n FROM fa) SELECT area, places, rank, greatest(0, n - 12) AS others FROM o WHERE rank <= 12")
def top_areas(spark, sf):
    return diff.first_areas(diff.area_facts(_areas(spark, sf))).select("area", "places", "rank", "others")


@query(f"WITH {_DIFF} SELECT id, kind, row_number() OVER (ORDER BY CASE kind WHEN 'added' THEN 1 WHEN 'removed' THEN 2 ELSE 3 END, name, id) AS rank FROM df WHERE kind <> 'same'")
def change_order(spark, sf):
    return places.in_change_order(_named_kinds(spark, sf).where("kind <> 'same'"), ["added", "removed", "changed"]).select("id", "kind", "rank")
