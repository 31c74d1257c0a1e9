"""Data-quality checks: rows that break a rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def violations(checks: dict[str, DataFrame], key: str) -> DataFrame:
    """(check_name, key): what each check found, under its name."""
    return reduce(DataFrame.unionAll, [df.select(F.lit(name).alias("check_name"), F.col(key).cast("string").alias("key")) for name, df in checks.items()])


def repeated(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values that more than one row has, and how many."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphans(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not known."""
    return df.join(known.select(key).distinct(), key, "left_anti").select(*df.columns)


def require(checks: DataFrame) -> None:
    """Raise if any check found something; names a few."""
    found = checks.limit(5).collect()
    if found:
        raise ValueError("; ".join(f"{r['check_name']}: {r['key']}" for r in found))


def tagged(rows: DataFrame, tags: DataFrame, category: str) -> DataFrame:
    """rows (id, name, categories) with each tag (target id or name, value) put on its row; see untagged() for tags that fit none."""
    by_id = tags.select(F.col("target").alias("id"), F.col("value").alias("_a"))
    by_name = tags.select(F.col("target").alias("name"), F.col("value").alias("_b"))
    fit = F.array_contains("categories", category)
    return rows.join(by_id, "id", "left").join(by_name, "name", "left").select(*rows.columns, F.when(fit, F.coalesce("_a", "_b")).alias("value"))


def untagged(rows: DataFrame, tags: DataFrame, category: str) -> DataFrame:
    """(check_name, key): tags whose target is missing, or lacks the category."""
    known = rows.select(F.explode(F.array("id", "name")).alias("target"), F.array_contains("categories", category).alias("fit")).groupBy("target").agg(F.max("fit").alias("fit"))
    met = tags.join(known, "target", "left")
    return violations({"missing target": met.where("fit is null"), "wrong category": met.where("not fit")}, "target")


def override_faults(known: DataFrame, areas: DataFrame, removed: DataFrame, patches: DataFrame, parents: DataFrame, pinned: DataFrame) -> DataFrame:
    """(check_name, key) for hand corrections without their target. known: slug, name, id of all places before any; areas: parent; removed: id; patches: id; parents: id, parent; pinned: slug, name, id."""
    ids, there = known.select("id").distinct(), areas.select("parent").distinct()
    lost = lambda df: df.select("id").distinct().join(ids, "id", "left_anti")
    return violations(
        {
            "removal of an unknown id": lost(removed),
            "patch of an unknown id": lost(patches),
            "parent of an unknown id": lost(parents),
            "unknown parent": parents.join(there, "parent", "left_anti").select("id"),
            "its own parent": parents.where(F.col("id").cast("string") == F.col("parent").cast("string")).select("id"),
            "pinned name not in its layer": pinned.join(known.select("slug", "name").distinct(), ["slug", "name"], "left_anti").select("id"),
            "id pinned twice": pinned.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"),
        },
        "id",
    )


def parent_names(spots: DataFrame, parents: DataFrame, prefix: str) -> DataFrame:
    """(check_name, key) for spots (id, name, parent): without a parent among (id, name), or with a name that doesn't begin with the prefix, a comma and the parent's name."""
    met = spots.join(parents.select(F.col("id").alias("parent"), F.col("name").alias("_owner")), "parent", "left")
    named = F.startswith(F.col("name"), F.concat(F.lit(f"{prefix}, "), F.col("_owner")))
    return violations({"no parent": met.where("_owner is null"), "not named for its parent": met.where(F.col("_owner").isNotNull() & ~F.coalesce(named, F.lit(False)))}, "id")


def only_if(rows: DataFrame, column: str, category: str) -> DataFrame:
    """(check_name, key) for rows where `column` is set without the category, or the category without `column`."""
    has, fit = F.col(column).isNotNull(), F.array_contains("categories", category)
    return violations({f"{column} without {category}": rows.where(has & ~fit), f"{category} without {column}": rows.where(~has & fit)}, "id")


def once_each(rows: DataFrame, key: str, value: str, wanted: str) -> DataFrame:
    """(check_name, key) for keys that don't have the wanted value exactly once."""
    n = rows.groupBy(key).agg(F.count_if(F.col(value) == wanted).alias("n"))
    return violations({f"{wanted}: not once": n.where("n <> 1")}, key)


def same_values(lines: DataFrame, source: DataFrame, key: list[str], but: list[str], ids: str) -> DataFrame:
    """(check_name, key) for rows whose key and values the source has not, but for the ids listed in `but`."""
    return violations({"differs from its source": lines.where(~F.col(ids).isin(but)).join(source.select(*key), key, "left_anti")}, ids)


def graph_faults(nodes: DataFrame, edges: DataFrame, entrances: DataFrame, types: list[str], bounds: tuple[float, float, float, float], met: DataFrame | None = None, ties: DataFrame | None = None) -> DataFrame:
    """(check_name, key) for a walking graph: nodes (id, x, y) out of bounds (west, south, east, north) or apart from the main component, edges (a, b, type) that are loops, dangle or have no known type, entrances (place, node) without a node.

    met: further edges, between two different nodes each, of which only the type
    is left to look at; ties (node, root): which nodes they connect.
    """
    from .graph import components

    west, south, east, north = bounds
    known = nodes.select("id").distinct()
    sound = edges.join(known.withColumnRenamed("id", "a"), "a").join(known.withColumnRenamed("id", "b"), "b")
    tied = sound.select("a", "b") if ties is None else sound.select("a", "b").unionByName(ties.select(F.col("node").alias("a"), F.col("root").alias("b")))
    roots = known.join(components(tied), F.col("id") == F.col("node"), "left").select("id", F.coalesce("root", "id").alias("root"))
    size = roots.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    main = size.agg(F.max(F.struct("n", (-F.col("root")).alias("turn"))).alias("t")).select((-F.col("t.turn")).alias("main"))
    apart = roots.join(F.broadcast(main), F.col("root") == F.col("main"), "left_anti")  # one row is sent
    ends = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    typed = edges.select("a", "b", "type") if met is None else edges.select("a", "b", "type").unionByName(met.select("a", "b", "type"))
    edge = lambda df: df.select(F.concat_ws("-", F.col("a").cast("string"), F.col("b").cast("string")).alias("id"))
    return violations(
        {
            "out of bounds": nodes.where(~(F.col("x").between(west, east) & F.col("y").between(south, north))).select("id"),
            "apart": apart.select("id"),
            "loop": edge(edges.where("a = b")),
            "dangling": ends.join(known, "id", "left_anti"),
            "unknown type": edge(typed.where(~F.col("type").isin(types))),
            "entrance without a node": entrances.select(F.col("node").alias("id")).distinct().join(known, "id", "left_anti"),
        },
        "id",
    )


def equal_categories(rows: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    """(check_name, key) for rows (id, kind, categories) whose categories, as a set, are not those of their kind."""
    table = F.create_map(*[v for k, c in wanted.items() for v in (F.lit(k), F.array(*[F.lit(x) for x in sorted(c)]))])
    return violations({"other categories": rows.where(~F.array_sort(F.array_distinct("categories")).eqNullSafe(F.try_element_at(table, F.col("kind"))))}, "id")
