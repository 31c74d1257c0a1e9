"""Layers to entities: unions, versions, names, ids, overrides."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import slug


def union_layers(layers: dict[str, DataFrame], tag: str = "_layer") -> DataFrame:
    """All rows of all layers, tagged by layer; a column that a layer lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn(tag, F.lit(name)) for name, df in layers.items()])


def manifest(sources: DataFrame, features: DataFrame, key: str) -> DataFrame:
    """Features of every known source, with those that have none."""
    n = features.groupBy(key).agg(F.count(F.lit(1)).alias("features"))
    return sources.select(key).distinct().join(n, key, "left").select(key, F.coalesce("features", F.lit(0)).alias("features")).withColumn("empty", F.col("features") == 0)


def read_version(snapshots: DataFrame, version: str) -> DataFrame:
    """Rows of one version; a version that no row has is an error."""
    rows = snapshots.where(F.col("snapshot_id") == version)
    if rows.isEmpty():
        raise ValueError(f"unknown version {version!r}")
    return rows


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly the declared columns; one that is missing is an error, a null is not."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*columns)


def drift(before: DataFrame, after: DataFrame, layer: str) -> DataFrame:
    """Layers that differ as multisets, with the number of rows that only one side has."""
    return before.exceptAll(after).unionAll(after.exceptAll(before)).groupBy(layer).agg(F.count(F.lit(1)).alias("differing"))


def category_word(rows: DataFrame, words: list[str], default: str = "place") -> DataFrame:
    """(id, word): the first of `words` among a row's categories, else its first category, else `default`."""
    known = F.array(*[F.lit(w) for w in words])
    found = F.get(F.filter(known, lambda w: F.array_contains(F.col("categories"), w)), 0)
    return rows.select("id", F.coalesce(found, F.replace(F.get("categories", 0), F.lit("-"), F.lit(" ")), F.lit(default)).alias("word"))


def release_names(versions: DataFrame, given: DataFrame | None = None) -> DataFrame:
    """(version, name): the smallest name that a version has already, else the next free one of its date: the date itself, then the date with -2, -3, ...

    versions: version, date; given: version, name, where a name may belong to a
    version that is not asked for.
    """
    if given is None:
        given = versions.select("version", F.col("date").alias("name")).limit(0)
    kept = given.groupBy("version").agg(F.min("name").alias("kept"))
    open_ = versions.join(kept, "version", "left_anti")
    # numbers that are taken, 1 for the bare date; the k-th open version of a date gets the k-th number that isn't
    number = F.when(F.length("name") == 10, F.lit(1)).otherwise(F.expr("try_cast(substring(name, 12) as int)"))
    taken = given.where(F.col("name").rlike("^.{10}(-([2-9]|[1-9][0-9]+))?$")).select(F.substring("name", 1, 10).alias("date"), number.alias("n")).distinct()
    wanted = open_.withColumn("turn", F.row_number().over(Window.partitionBy("date").orderBy("version")))
    # a taken number shifts the turns above the free numbers below it: both in one order, taken ones counted as they come
    shifts = taken.select("date", (F.col("n") - F.row_number().over(Window.partitionBy("date").orderBy("n"))).alias("turn"), F.lit(None).cast(versions.schema["version"].dataType).alias("version"), F.lit(1).alias("shift"))
    both = wanted.select("date", "turn", "version", F.lit(0).alias("shift")).unionByName(shifts)
    moved = both.withColumn("over", F.sum("shift").over(Window.partitionBy("date").orderBy("turn", "shift").rowsBetween(Window.unboundedPreceding, 0))).where("shift = 0")
    n = (F.col("turn") + F.col("over")).cast("int")
    new = moved.select("version", F.when(n == 1, F.col("date")).otherwise(F.concat("date", F.lit("-"), n.cast("string"))).alias("name"))
    return versions.select("version").join(kept, "version").select("version", F.col("kept").alias("name")).unionByName(new)


def assign_ids(rows: DataFrame, prefix: str, name: Column, order: str = "pos", pinned: str | None = None) -> DataFrame:
    """rows with id: the pinned one, else prefix and slug of the name, the prefix not twice; names that share a slug are numbered in order.

    A pinned id keeps its row's place in the numbers of the others.
    """
    base = slug(name)
    base = F.when(F.startswith(base, F.lit(prefix)), base).otherwise(F.concat(F.lit(prefix), base))
    named = rows.withColumn("_base", base)
    w = Window.partitionBy("_base")
    own = F.when(F.count(F.lit(1)).over(w) == 1, F.col("_base")).otherwise(F.concat("_base", F.lit("-"), F.row_number().over(w.orderBy(order)).cast("string")))
    return named.withColumn("id", F.coalesce(F.col(pinned), own) if pinned else own).drop("_base")


def lookup_last(rows: DataFrame, known: DataFrame, key: str, value: str) -> DataFrame:
    """rows with the value of their key; of several the last (by pos) counts; null if unknown."""
    last = known.groupBy(key).agg(F.max_by(value, "pos").alias(value))
    return rows.join(last, key, "left")


def patched(rows: DataFrame, patches: DataFrame, fields: list[str]) -> DataFrame:
    """rows (id, fields) with patches (id, field, value, pos) applied: the last patch of a field counts, and its null overwrites."""
    last = patches.groupBy("id", "field").agg(F.max_by(F.struct("value"), "pos").alias("p"))
    wide = last.groupBy("id").agg(*[F.max(F.when(F.col("field") == f, F.col("p"))).alias(f"_{f}") for f in fields])
    rest = [c for c in rows.columns if c not in fields]
    return rows.join(wide, "id", "left").select(*rest, *[F.when(F.col(f"_{f}").isNotNull(), F.col(f"_{f}.value")).otherwise(F.col(f)).alias(f) for f in fields])


#: Rounds by the lowest corners end when they grow no more and settle less than this part of what is left.
FEW_JOIN = 20


def _by_first_ones(corners: DataFrame, joined: DataFrame, reach_m: float) -> DataFrame:
    """(id, root): pieces whose corners (id, name, x, y) lie within reach of a corner of a lower piece that has joined (id, name, root, x, y: its corners). Of the joined ones only the lowest of each small cell is looked at, so some may be missed."""
    from .grid import _point_boxes, _this_side, box_cells, dealt, metres, point_cells

    # the cells in which the lowest are told are half as wide as those in which they are looked up
    first = point_cells(joined, reach_m / 2).groupBy("name", "cx", "cy").agg(F.min(F.struct("id", "x", "y", "root")).alias("r"))
    held = _point_boxes(first.select("name", F.col("r.id").alias("a"), F.col("r.x").alias("bx"), F.col("r.y").alias("by"), F.col("r.root").alias("root")), "bx", "by")
    met = dealt(point_cells(corners, reach_m), box_cells(held, reach_m), ["name", "cx", "cy"]).where("a < id").withColumn("bx", F.col("bx") + F.col("shift"))
    # the corner is the centre; a hair less than the reach, as the outline is measured otherwise
    sure = _this_side(F.col("bx") - F.col("x")) & (metres(F.col("x"), F.col("y"), F.col("bx"), F.col("by")) <= reach_m * (1 - 1e-9))
    return met.where(sure).groupBy("id").agg(F.min("root").alias("root"))


def merged_pieces(vertices: DataFrame, reach_m: float, rounds: int = 1000) -> DataFrame:
    """(id, root): pieces of one name that join the first piece of that name, in the order of their ids.

    vertices: id, name, ring, seq, x, y. A piece joins if one of its corners
    lies within reach of what has joined before it; others stay apart, as their
    own root. As only earlier pieces count, a piece joins if a chain of rising
    ids leads to it from the first, which rounds of joins find for all names at once.

    The lowest corners of small cells settle most pieces of a dense name, round
    by round; when they bring few more, what is left is compared with the
    outlines of all lower pieces of its name.
    """
    from ..storage import cut
    from .grid import within_polygons
    from .measures import segments

    # a name that is missing is a name as well
    v = cut(vertices.select("id", F.coalesce(F.concat(F.lit("="), F.col("name").cast("string")), F.lit("")).alias("name"), "ring", "seq", "x", "y"))
    names = v.groupBy("id").agg(F.first("name").alias("name"))
    v = cut(v.drop("name").join(names, "id"))
    corners = v.select("id", "name", "x", "y").distinct()
    joined = cut(names.groupBy("name").agg(F.min("id").alias("id")).select("id", F.col("id").alias("root")))
    left, n, before = cut(corners.join(joined.select("id"), "id", "left_anti")), 1, 0
    # most rounds bring more than the one before, or a good part of what is left
    while n and (n >= before or n * FEW_JOIN > left.select("id").distinct().count()):
        new, before = cut(_by_first_ones(left, corners.join(joined, "id"), reach_m)), n
        n = new.count()
        joined, left = cut(joined.unionByName(new)), cut(left.join(new.select("id"), "id", "left_anti"))
    shapes = segments(v, ["id", "ring"], ("name",)).withColumnRenamed("id", "fid")
    met = within_polygons(left.select(F.struct("id", "x", "y").alias("id"), "name", "x", "y"), shapes, reach_m, ("name",))
    pairs = cut(met.select(F.col("fid").alias("a"), F.col("id.id").alias("b")).where("a < b").distinct())
    front = joined
    for _ in range(rounds):
        new = front.join(pairs, F.col("id") == F.col("a")).groupBy("b").agg(F.min("root").alias("root")).withColumnRenamed("b", "id")
        front = cut(new.join(joined.select("id"), "id", "left_anti"))
        if front.isEmpty():
            return names.select("id").join(joined, "id", "left").select("id", F.coalesce("root", "id").alias("root"))
        joined = cut(joined.unionByName(front))
    raise RuntimeError(f"pieces did not settle in {rounds} rounds")
