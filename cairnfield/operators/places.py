"""Places: what they are called, what is shown of them, rules and anchors given by hand, and the chain that builds them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import blank_to_null, casefolded, slug
from ..functions.shapes import shape_hash
from ..storage import cut
from . import conflate, grid
from .checks import override_faults, tagged, untagged


def tile_properties(features: DataFrame, kind: Column) -> DataFrame:
    """(buildingId, name, kind): the few properties that a map tile carries; a name that is missing is empty."""
    return features.select(F.col("id").alias("buildingId"), F.coalesce("name", F.lit("")).alias("name"), kind.alias("kind"))


def first_categories(after: Column, before: Column) -> Column:
    """The new record's categories, else the old one's; an empty list counts as none."""
    full = lambda c: F.when(F.size(c) > 0, c)
    return F.coalesce(full(after), full(before))


def background(features: DataFrame, place_slugs: list[str]) -> DataFrame:
    """Features that are background: with positions (n), and of a layer that gives no places or without a name."""
    return features.where((F.col("n") > 0) & (~F.col("slug").isin(place_slugs) | blank_to_null(F.col("name")).isNull()))


def of_category(places: DataFrame, category: str) -> DataFrame:
    """Places (id, categories, ...) of a category."""
    return places.where(F.array_contains("categories", category))


def named_first(label: Column, name: Column) -> Column:
    """Whether a label begins with the name of a place, both as ids."""
    return F.startswith(slug(label), slug(name))


def preferred_within(points: DataFrame, segments: DataFrame, areas: DataFrame, reach_m: float) -> DataFrame:
    """(id, parent): for each point (id, x, y, label) the one of the areas within reach that its label names first, else the nearest; ties to the lower fid. segments: fid, ring, x0, y0, x1, y1; areas: fid, name.

    Not all pairs within reach are made: a point meets the areas whose names its
    label begins with, and looks for the nearest one.
    """
    sides = segments.select("fid", "ring", "x0", "y0", "x1", "y1").join(areas.select("fid").distinct(), "fid", "left_semi")
    names = cut(areas.select("fid", slug(F.col("name")).alias("key")).where("key is not null").distinct())
    # a label begins with a name if its first letters, as many as the name has, are the name; names have a few dozen lengths at most
    lengths = sorted(r[0] for r in names.select(F.length("key")).distinct().collect())
    starts = F.transform(F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("_label")), lambda n: F.substring("_label", F.lit(1), n)) if lengths else F.array().cast("array<string>")
    spots = points.select("id", "x", "y", slug(F.col("label")).alias("_label")).select("id", "x", "y", F.explode(starts).alias("key"))
    # with its key an id or an area is there once, however many names fit or an area has
    own = lambda c: F.struct(c, "key").alias(c)
    met = grid.within_polygons(spots.select(own("id"), "key", "x", "y"), sides.join(names, "fid").select(own("fid"), "key", "ring", "x0", "y0", "x1", "y1"), reach_m, ("key",))
    named = met.groupBy("id.id").agg(F.min(F.struct("m", "fid.fid")).alias("t")).select("id", F.col("t.fid").alias("named"))
    near = grid.nearest_area(points, sides, reach_m)
    return near.join(named, "id", "left").select("id", F.coalesce("named", "fid").alias("parent"))


def entrances_of(entrances: DataFrame) -> DataFrame:
    """(place, nodes): the different entrances of each place (place, node), ascending. A place has a few dozen at most."""
    return entrances.where("place is not null").groupBy("place").agg(F.sort_array(F.collect_set("node")).alias("nodes"))


def in_change_order(changes: DataFrame, kinds: list[str]) -> DataFrame:
    """changes (kind, name, id) with their rank, from 1: by kind in the order given, then name, then id."""
    from .ranks import ranked

    order = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("kind"))
    return ranked(changes.withColumn("_kind", order), ["_kind", "name", "id"]).drop("_kind")


def united(parts: list[DataFrame], key: str = "id") -> DataFrame:
    """All rows of all parts; a key that two rows share is an error when the result is used."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    n = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    text = F.concat(F.lit(f"{key} "), F.col(key).cast("string"), F.lit(" is taken twice"))
    # a filter, so that the check is not pruned away with the column
    return rows.join(n, key).where(F.when(F.col("_n") > 1, F.raise_error(text).cast("boolean")).otherwise(True)).drop("_n")


def ruled(places: DataFrame, categories: list[str], shared: list[str], swaps: DataFrame, link: tuple[str, str]) -> DataFrame:
    """places (id, categories, links, ...) with rules: the shared ones, in order, for those of one of the categories, else none.

    swaps (id, rule, instead) puts another text in a rule's place for one id.
    Those with rules get the link (label, href) too, unless they have it.
    """
    fit = F.arrays_overlap("categories", F.array(*[F.lit(c) for c in categories]))
    own = swaps.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("rule", "instead"))).alias("_swaps"))
    rules = F.transform(F.array(*[F.lit(r) for r in shared]), lambda r: F.coalesce(F.try_element_at("_swaps", r), r))
    more = F.array_union("links", F.array(F.struct(F.lit(link[0]).alias("label"), F.lit(link[1]).alias("href"))))
    rows = places.join(own, "id", "left")
    rest = [c for c in places.columns if c != "links"]
    return rows.select(*rest, F.when(fit, more).otherwise(F.col("links")).alias("links"), F.when(fit, rules).otherwise(F.array().cast("array<string>")).alias("rules"))


def anchored(places: DataFrame, anchors: DataFrame) -> DataFrame:
    """places (id, x, y, ...) with the anchors (id, x, y, pos) that were given by hand; of several the last counts."""
    last = anchors.groupBy("id").agg(F.max_by(F.struct("x", "y"), "pos").alias("_at"))
    rest = [c for c in places.columns if c not in ("x", "y")]
    return places.join(last, "id", "left").select(*rest, F.coalesce("_at.x", "x").alias("x"), F.coalesce("_at.y", "y").alias("y"))


def in_canonical_order(features: DataFrame) -> DataFrame:
    """features (name, shape, ...) with their rank, from 1: by folded name, those without one first, then by the hash of the shape; what agrees in both by all columns."""
    from .ranks import ranked

    rows = features.withColumns({"_name": F.coalesce(casefolded(blank_to_null(F.col("name"))), F.lit("")), "_hash": F.coalesce(shape_hash(F.col("shape")), F.lit(""))})
    rows = rows.withColumn("_row", F.xxhash64(*features.columns))
    return ranked(rows, ["_name", "_hash", "_row"]).drop("_name", "_hash", "_row")


def lines_not_drawn(lines: DataFrame, drawn: DataFrame) -> DataFrame:
    """lines (shape, ...) whose shape, to 7 places, none of `drawn` (shape) has, whatever their ids."""
    known = drawn.select(shape_hash(F.col("shape")).alias("_hash")).distinct()
    return lines.withColumn("_hash", shape_hash(F.col("shape"))).join(known, "_hash", "left_anti").select(*lines.columns)


def trail_features(pieces: DataFrame, slug_: str, categories: list[str]) -> DataFrame:
    """Trails (trail, nth, part, seq, x, y: see trails.trail_pieces) as features named by `trail`, at the middle vertex of all their pieces: slug, pos, name, x, y, categories, links."""
    from .measures import anchors
    from .ranks import ranked

    lines = ranked(pieces.select("trail", "nth", "part").distinct(), ["trail", "nth", "part"]).withColumnRenamed("rank", "line")
    # a piece may begin behind its cut, so vertices are counted anew
    first = pieces.groupBy("trail", "nth", "part").agg(F.min("seq").alias("first"))
    v = pieces.join(lines, ["trail", "nth", "part"]).join(first, ["trail", "nth", "part"])
    v = v.select(F.col("trail").alias("id"), F.lit("line").alias("kind"), F.col("line").alias("part"), F.lit(0).alias("ring"), (F.col("seq") - F.col("first")).alias("seq"), "x", "y")
    links = F.array().cast("array<struct<label:string,href:string>>")
    at = ranked(anchors(v), ["id"])
    return at.select(F.lit(slug_).alias("slug"), F.col("rank").cast("long").alias("pos"), F.col("id").cast("string").alias("name"), "x", "y", F.array(*[F.lit(c) for c in categories]).alias("categories"), links.alias("links"))


def built(features: DataFrame, superseded: DataFrame, areas: DataFrame, reach_m: float, prefix: str, removed: DataFrame, patches: DataFrame, anchors: DataFrame, additions: DataFrame, rules: dict, trails: DataFrame | None = None, pinned: DataFrame | None = None, parts: DataFrame | None = None, parents: DataFrame | None = None, walks: tuple[DataFrame, str] | None = None, floors: DataFrame | None = None) -> DataFrame:
    """The chain from features to places, in the order in which its steps depend on each other.

    features: slug, pos, name, x, y, categories, links. Unnamed ones are no
    places; superseded ones (slug, name) go; trails (as trail_features() gives
    them) come in; ids are given, those that are pinned (slug, name, id, and pos if need be) kept;
    each place gets the nearest area (fid, owner, ring, x0, y0, x1, y1) within
    reach, before names change, but for parents set by hand (id, parent); parts
    (id, name, x, y, categories, links) become places of their own; then
    removals (id), patches of names (id, field, value, pos), anchors (id, x, y,
    pos) and additions (id, name, x, y, categories, links) apply, and an id
    taken twice is an error; then places are named after their area; then rules
    (arguments of `ruled`), walks (tags (target id or name, value) and the
    category that they are for) and floors (href, floors), by a place's first
    link that has some, are attached. Columns: id, name, x, y, parent,
    categories, links, rules, walk, floors.
    """
    places = features.withColumn("name", blank_to_null(F.col("name"))).where("name is not null")
    places = places.join(superseded.select("slug", "name").distinct(), ["slug", "name"], "left_anti")
    if trails is not None:
        places = places.unionByName(trails)
    fixed = None
    if pinned is not None:
        # where several features of a layer have one name, pos tells which of them is meant
        by = ["slug", "name", *(c for c in ("pos",) if c in pinned.columns)]
        places, fixed = places.join(pinned.select(*by, F.col("id").alias("pin")), by, "left"), "pin"
    places = conflate.assign_ids(places, prefix, F.col("name"), "pos", fixed)
    parent = grid.nearest_area(places, areas, reach_m).select("id", F.col("fid").alias("parent"))
    places = places.join(parent, "id", "left")
    if parents is not None:
        places = places.join(parents.select("id", F.col("parent").alias("set")), "id", "left").withColumn("parent", F.coalesce("set", "parent")).drop("set")
    # what follows looks at all places more than once
    places = cut(places.select("id", "name", "x", "y", "parent", "categories", "links"))
    if parts is not None:
        places = united([places, parts])
    places = places.join(removed.select("id").distinct(), "id", "left_anti")
    places = conflate.patched(places, patches, ["name"])
    places = cut(united([anchored(places, anchors), additions]))
    owners = areas.groupBy("fid").agg(F.min("owner").alias("owner")).withColumnRenamed("fid", "parent")
    name = F.when(F.col("owner").isNull(), F.col("name")).otherwise(F.concat("name", F.lit(", "), "owner"))
    named = ruled(places.join(owners, "parent", "left").select("id", name.alias("name"), "x", "y", "parent", "categories", "links"), **rules)
    named = tagged(named, *walks).withColumnRenamed("value", "walk") if walks is not None else named.withColumn("walk", F.lit(None).cast("string"))
    if floors is None:
        return named.withColumn("floors", F.lit(None).cast("array<string>"))
    linked = named.select("id", F.posexplode("links").alias("at", "l")).join(floors.select(F.col("href").alias("_href"), "floors"), F.col("l.href") == F.col("_href"))
    first = linked.groupBy("id").agg(F.min_by("floors", "at").alias("floors"))
    return named.join(first, "id", "left")


def chain_faults(features: DataFrame, areas: DataFrame, prefix: str, removed: DataFrame, patches: DataFrame, parents: DataFrame, pinned: DataFrame, places: DataFrame | None = None, walks: tuple[DataFrame, str] | None = None) -> DataFrame:
    """(check_name, key): corrections of built() whose target isn't there. places: its result, for walks. Give it to checks.require() before anything is written."""
    named = features.withColumn("name", blank_to_null(F.col("name"))).where("name is not null").join(pinned.select("slug", "name", F.col("id").alias("pin")), ["slug", "name"], "left")
    known = conflate.assign_ids(named, prefix, F.col("name"), "pos", "pin").select("slug", "name", "id")
    out = override_faults(known, areas.select(F.col("fid").alias("parent")), removed, patches, parents, pinned)
    return out if walks is None or places is None else out.unionByName(untagged(places, *walks))
