"""Change detection between two versions of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import metres
from ..storage import cut
from .grid import box_cells, dealt, point_cells


def keyed_diff(before: DataFrame, after: DataFrame, key: str, fields: list[str], carried: tuple[str, ...] = ()) -> DataFrame:
    """(key, kind, carried): added, removed, changed or same; null equals null. A key that one version has twice gives a row for each pair of its rows, with the carried columns of that pair, the earlier value first."""
    b, a = before.alias("b"), after.alias("a")
    same = F.lit(True)
    for f in fields:
        same = same & F.col(f"b.{f}").eqNullSafe(F.col(f"a.{f}"))
    kind = F.when(F.col(f"b.{key}").isNull(), "added").when(F.col(f"a.{key}").isNull(), "removed").when(same, "same").otherwise("changed")
    return b.join(a, F.col(f"b.{key}") == F.col(f"a.{key}"), "full").select(F.coalesce(f"b.{key}", f"a.{key}").alias(key), kind.alias("kind"), *[F.coalesce(f"b.{c}", f"a.{c}").alias(c) for c in carried])


def field_diff(before: DataFrame, after: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, old, new) for fields of rows in both versions that differ; absent and null are alike."""
    long = lambda df, name: df.select(key, *[F.col(f).cast("string").alias(f) for f in fields]).unpivot(key, fields, "field", name)
    return long(before, "old").join(long(after, "new"), [key, "field"]).where(~F.col("old").eqNullSafe(F.col("new")))


def multiset_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that one side has more often, with side and how often more."""
    cols = before.columns
    both = before.withColumn("_n", F.lit(-1)).unionByName(after.withColumn("_n", F.lit(1)))
    n = both.groupBy(*cols).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    return n.select(*cols, F.when(F.col("_n") > 0, "added").otherwise("removed").alias("side"), F.abs("_n").alias("n"))


def paired_renames(removed: DataFrame, added: DataFrame, reach_m: float, rounds: int = 60) -> DataFrame:
    """(old, new, m): each removed id, in order, takes the nearest free added id of its kind within reach; ties to the lower id.

    removed, added: id, kind, x, y. Done in rounds of proposals: every unpaired
    old id proposes to its nearest new id that has not yet refused it, and a new
    id keeps the lowest old id that ever proposed. This ends in the pairs that
    going through the old ids one by one gives.
    """
    old = point_cells(removed.select(F.col("id").alias("old"), "kind", "x", "y"), reach_m)
    new = added.select(F.col("id").alias("new"), "kind", F.col("x").alias("tx"), F.col("y").alias("ty")).withColumns({"min_x": F.col("tx"), "max_x": F.col("tx"), "min_y": F.col("ty"), "max_y": F.col("ty")})
    met = dealt(old, box_cells(new, reach_m), ["kind", "cx", "cy"]).withColumn("m", metres(F.col("x"), F.col("y"), F.col("tx"), F.col("ty"))).where(F.col("m") <= reach_m)
    open_ = cut(met.select("old", "new", "m"))
    held = None
    for _ in range(rounds):
        asks = open_.groupBy("old").agg(F.min(F.struct("m", "new")).alias("t")).select("old", F.col("t.new").alias("new"), F.col("t.m").alias("m"))
        best = asks.groupBy("new").agg(F.min("old").alias("old"))
        # an old id is refused where a lower one asks; the refused pair is out for good
        refused = asks.join(best.withColumnRenamed("old", "winner").hint("merge"), "new").where("old <> winner").select("old", "new")
        held = asks.join(best.hint("merge"), ["new", "old"]).select("old", "new", "m")
        if refused.isEmpty():
            return held
        open_ = cut(open_.join(refused.hint("merge"), ["old", "new"], "left_anti"))
    raise RuntimeError(f"pairs did not settle in {rounds} rounds")


#: Characters of text whose words one task counts.
CHARS_A_TASK = 4_000_000


def in_even_parts(rows: DataFrame, key: str, text: str) -> DataFrame:
    """rows dealt out by `key` into as many parts as their text asks for, the shuffle partitions at least: what is made of a part does not grow with the table. AQE does not gather them again."""
    chars = rows.agg(F.sum(F.length(text).cast("long"))).first()[0] or 0
    return rows.repartition(max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-chars // CHARS_A_TASK)), key)


def word_bag_diff(rows: DataFrame, key: list[str], before: str, after: str) -> DataFrame:
    """(key, word, n): words that `after` has more (n > 0) or less often than `before`.

    Both sides of a row are counted where it lies: rows that are dealt out by a
    column of the key are not shuffled again.
    """
    words = lambda c, n: F.transform(F.filter(F.split(F.coalesce(c, F.lit("")), r"\s+"), lambda w: w != ""), lambda w: F.struct(w.alias("word"), F.lit(n).alias("n")))
    both = rows.select(*key, F.explode(F.concat(words(F.col(before), -1), words(F.col(after), 1))).alias("w")).select(*key, "w.word", "w.n")
    return both.groupBy(*key, "word").agg(F.sum("n").alias("n")).where("n <> 0")


def word_runs(before: str, after: str) -> list[tuple[str, str]]:
    """Runs (kind, words) that turn one text into the other."""
    from difflib import SequenceMatcher

    a, b = before.split(), after.split()
    out = []
    for op, i, j, k, m in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if op == "equal":
            out.append(("same", " ".join(a[i:j])))
        else:
            out += [("removed", " ".join(a[i:j]))] * (j > i) + [("added", " ".join(b[k:m]))] * (m > k)
    return out


def word_diff(rows: DataFrame, key: list[str], before: str, after: str) -> DataFrame:
    """(key, run, kind, words): word runs of each row whose texts differ."""
    import pandas as pd

    differ = rows.where(~F.col(before).eqNullSafe(F.col(after))).select(*key, before, after)

    def runs(batches):
        for pdf in batches:
            held = [(*row[: len(key)], i, kind, words) for row in pdf.itertuples(index=False) for i, (kind, words) in enumerate(word_runs(row[-2] or "", row[-1] or ""))]
            yield pd.DataFrame(held, columns=[*key, "run", "kind", "words"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in differ.schema if f.name in key] + ["run int, kind string, words string"])
    return differ.mapInPandas(runs, schema)


def summarised(changes: DataFrame, group: list[str], name: str, most: int = 10, shown: int = 3) -> DataFrame:
    """Per group: n, and names: all if there are at most `most`, cut to `shown` and "and n more" beyond `shown`.

    Names are kept while grouping only as far as they can be shown: the lowest ones.
    Missing names come last and aren't written; where all that would be shown are missing, there is no text.
    """
    w = Window.partitionBy(*group).orderBy(F.asc_nulls_last(name))
    n = F.count(F.lit(1)).over(Window.partitionBy(*group))
    lowest = changes.withColumns({"_rn": F.row_number().over(w), "_n": n}).where(F.col("_rn") <= shown)
    out = lowest.groupBy(*group).agg(F.first("_n").alias("n"), F.array_sort(F.collect_list(name)).alias("_names"))
    out = out.withColumn("_names", F.when(F.size("_names") > 0, F.array_join("_names", ", ")))
    text = F.when(F.col("n") > most, F.lit(None)).when(F.col("n") > shown, F.concat("_names", F.lit(" and "), (F.col("n") - shown).cast("string"), F.lit(" more"))).otherwise(F.col("_names"))
    return out.select(*group, "n", text.alias("names"))


def change_areas(changes: DataFrame, reach_m: float, new_layer: int = 20) -> DataFrame:
    """changes with area: places (id, kind, x, y, ...) that lie near each other, named by the smallest id.

    More than `new_layer` added points are a new layer and form one area together, wherever they lie.
    """
    from .grid import linked_points

    added = changes.where("kind = 'added'").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).first()
    layer = F.col("kind") == "added" if added["n"] > new_layer else F.lit(False)
    rest = changes.where(~layer)
    roots = linked_points(rest, reach_m)
    own = rest.join(roots, F.col("id") == F.col("node"), "left").select(*changes.columns, F.coalesce("root", "id").alias("area"))
    if added["n"] <= new_layer:
        return own
    return own.unionByName(changes.where(layer).withColumn("area", F.lit(added["first"])))


def area_facts(areas: DataFrame) -> DataFrame:
    """(area, places, added, removed, moved, most_m, north, west): counts by kind, the longest move, and the northernmost place (the westernmost of these). areas: area, kind, x, y, metres (of moves)."""
    kind = lambda k: F.count_if(F.col("kind") == k).alias(k)
    top = F.max(F.struct("y", (-F.col("x")).alias("w"))).alias("t")
    got = areas.groupBy("area").agg(F.count(F.lit(1)).alias("places"), kind("added"), kind("removed"), kind("moved"), F.max("metres").alias("most_m"), top)
    return got.select("area", "places", "added", "removed", "moved", "most_m", F.col("t.y").alias("north"), (-F.col("t.w")).alias("west"))


def first_areas(facts: DataFrame, most: int = 12) -> DataFrame:
    """The `most` areas furthest north, then west, with their rank and, in `others`, how many are left out."""
    from .ranks import ranked

    n = facts.count()
    return ranked(facts, [F.desc("north"), F.asc("west"), F.asc("area")]).where(F.col("rank") <= most).withColumn("others", F.lit(max(0, n - most)).cast("long"))
