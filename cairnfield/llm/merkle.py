"""A Merkle manifest of a table: a root for the whole, a proof for each row.

Rows become leaves where they are read, so only hashes move. Leaves are ranked
inside their source by ranges, and each run of SUPER leaves (a superblock) is
reduced to one node. The nodes above are few; they are reduced a level at a
time by groups of at most FAN, first inside each source, then over the sources,
and the nodes beside the way to the root are handed down again from parents to
children, so no key holds more than FAN rows. Last, leaves and the outer nodes
that they need are cogrouped by superblock, and one function reduces the
superblock again, joins the proofs and folds the altered leaves.
"""

from __future__ import annotations

from collections.abc import Iterable
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, ship, stored

FAN, LOCAL_LEVELS = 16, 3
SUPER = FAN**LOCAL_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_of(columns: Iterable[Column]) -> Column:
    """SHA-256 of the columns, each as its UTF-8 byte count, a colon and its value, or - if null."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]).cast("binary"), 256)


def fold_proof(leaf: Column, proof: Column) -> Column:
    """The root that follows from a leaf (hex) and a proof, an array of (before, after)."""
    return F.aggregate(proof, leaf, lambda h, p: F.sha2(F.concat(p["before"], h, p["after"]).cast("binary"), 256))


def _h(data: bytes) -> bytes:
    return sha256(data).hexdigest().encode()


def _levels(nodes: list[bytes], whole: bool) -> list[list[bytes]]:
    """Leaves, then each level above: up to one node for a whole source, else up to the superblock's node."""
    levels = [nodes]
    while len(levels[-1]) > 1 if whole else len(levels) <= LOCAL_LEVELS:
        now = levels[-1]
        levels.append([_h(b"".join(now[i : i + FAN])) for i in range(0, len(now), FAN)])
    return levels


def _reduce(key: tuple, leaves: pd.DataFrame) -> pd.DataFrame:
    leaves = leaves.sort_values("at")
    top = _levels([bytes(x).hex().encode() for x in leaves["leaf"]], leaves["total"].iloc[0] <= SUPER)[-1][0]
    return pd.DataFrame({"own": [key[0]], "at": [key[1]], "h": [top.decode()], "total": [-(-int(leaves["total"].iloc[0]) // SUPER)]})


def _finish(key: tuple, leaves: pd.DataFrame, outer: pd.DataFrame, with_proof: bool) -> pd.DataFrame:
    """One superblock: its leaves, and one row with the outer nodes of its way to the root."""
    leaves = leaves.sort_values("at")
    names = [bytes(x).hex().encode() for x in leaves["leaf"]]
    levels = _levels(names, leaves["total"].iloc[0] <= SUPER)[:-1]
    runs = [[b"".join(level[i : i + FAN]) for i in range(0, len(level), FAN)] for level in levels]
    above = [(b"".join(h.encode() for h in o["nodes"][: o["at"]]), b"".join(h.encode() for h in o["nodes"][o["at"] + 1 :])) for o in outer["outer"].iloc[0]]
    proofs, folded, whole = [], [], []
    for i, altered in enumerate(leaves["altered"]):
        way, at = [], i
        for level in runs:
            run, slot = level[at // FAN], 64 * (at % FAN)
            way.append((run[:slot], run[slot + 64 :]))
            at //= FAN
        way += above
        h = names[i] if altered is None else bytes(altered).hex().encode()
        for before, after in way:
            h = _h(before + h + after)
        proofs.append(_h(b"".join(x for pair in way for x in pair)).decode())
        folded.append(h.decode())
        if with_proof:
            whole.append([{"before": a.decode(), "after": b.decode()} for a, b in way])
    out = pd.DataFrame({"doc_id": leaves["doc_id"].to_numpy(), "leaf": [x.decode() for x in names], "subroot": outer["subroot"].iloc[0], "proof_sha256": proofs, "folded_root": folded})
    return out.assign(proof=pd.Series(whole, dtype=object)) if with_proof else out


def _placed(leaves: DataFrame) -> DataFrame:
    """leaves with at (from 0) and total in their own source, ranked inside ranges plus what the ranges before hold of it."""
    order = ["own", "id", "leaf", "row"]
    parts = cut(leaves.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    # one row for each range and source in it
    counts = parts.groupBy("part", "own").agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("own")
    ahead = counts.select("part", "own", (F.sum("n").over(own.orderBy("part")) - F.col("n")).alias("ahead"), F.sum("n").over(own).alias("total"))
    at = F.row_number().over(Window.partitionBy("part", "own").orderBy(F.col("id").asc_nulls_first(), "leaf", "row")) - 1 + F.col("ahead")
    return parts.join(ahead, ["part", "own"]).withColumn("at", at).drop("part", "ahead")


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """nodes (own, at, h, total in own) reduced to one for each own. Gives the runs (own, at, nodes) of each level from below, and the last nodes (own, h, levels below it)."""
    runs, tops = [], []
    most = nodes.agg(F.max("total")).first()[0] or 0
    while True:
        tops.append(nodes.where("total = 1").select("own", "h", F.lit(len(runs)).alias("depth")))
        if most <= 1:
            break
        run = nodes.where("total > 1").groupBy("own", F.floor(F.col("at") / FAN).alias("at"), "total").agg(F.array_sort(F.collect_list(F.struct("at", "h"))).alias("s"))
        run = cut(run.select("own", "at", F.col("s.h").alias("nodes"), F.ceil(F.col("total") / FAN).alias("total")))
        runs.append(run)
        nodes = run.select("own", "at", F.sha2(F.array_join("nodes", "").cast("binary"), 256).alias("h"), "total")
        most = -(-most // FAN)
    top = tops[0]
    for t in tops[1:]:
        top = top.unionByName(t)
    return runs, cut(top)


def _descend(runs: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(own, at, outer, subroot) for each node that _climb began with: the outer nodes on its way up, lowest first. tops: (own, depth, outer, subroot) for each own's last node."""
    way = tops.select("own", F.lit(0).cast("long").alias("at"), "depth", "outer", "subroot")
    for k in range(len(runs) - 1, -1, -1):
        below = runs[k].select("own", "at", "nodes").join(way, ["own", "at"]).select("own", F.col("at").alias("run"), "depth", "outer", "subroot", "nodes", F.posexplode("nodes").alias("slot", "h"))
        down = below.select("own", (F.col("run") * FAN + F.col("slot")).alias("at"), "depth", F.concat(F.array(F.struct("nodes", F.col("slot").alias("at"))), "outer").alias("outer"), "subroot")
        # an own with fewer levels waits until its uppermost is reached
        way = down.unionByName(way.where(F.col("depth") <= k))
    return way.drop("depth")


def manifest(docs: DataFrame, altered: Column | None = None, is_altered: Column | None = None, fields: Iterable[str] = FIELDS, with_proof: bool = False) -> DataFrame:
    """Per row: doc_id, leaf, subroot (of its source), root, proof_sha256, folded_root, verified and, if asked for, proof.

    A leaf is made of `fields`. Leaves ascend by doc_id inside their source,
    rows without one first, repeated ids by leaf; sources ascend bytewise, the
    null one first and apart from the empty one. altered: what text becomes in
    the rows where is_altered holds; their leaf is made anew and folded with
    the proof of the unaltered tree. Other columns are ignored; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    leaf = leaf_of(F.col(c) for c in fields)
    again = F.lit(None).cast("binary") if altered is None else F.when(F.coalesce(is_altered, F.lit(False)), F.unhex(leaf_of(altered if c == "text" else F.col(c) for c in fields)))
    # sources as non-null texts in the same order
    own = F.coalesce(F.concat(F.lit("+"), F.col("source").cast("string")), F.lit(""))
    leaves = stored(docs.select(F.col("doc_id").cast("long").alias("id"), own.alias("own"), F.unhex(leaf).alias("leaf"), again.alias("altered")), "merkle-leaves")
    placed = cut(_placed(leaves.withColumn("row", F.monotonically_increasing_id())).withColumn("block", F.floor(F.col("at") / SUPER)))
    supers = cut(placed.select("own", "block", "at", "leaf", "total").groupBy("own", "block").applyInPandas(_reduce, "own string, at long, h string, total long"))
    runs, subroots = _climb(supers)
    # the sources are ranked as leaves are, under one name
    ranked = _placed(subroots.select(F.lit("").alias("own"), F.col("own").alias("id"), "h", F.lit("").alias("leaf"), F.lit(0).alias("row")))
    ranked = cut(ranked.select("own", "at", "h", "total", F.col("id").alias("source")))
    top_runs, roots = _climb(ranked.select("own", "at", "h", "total"))
    root = roots.first()
    none = F.array().cast("array<struct<nodes:array<string>,at:int>>")
    tops = _descend(top_runs, roots.select("own", "depth", none.alias("outer"), F.lit(None).cast("string").alias("subroot")))
    tops = ranked.join(tops.select("at", "outer"), "at").select(F.col("source").alias("own"), "outer", F.col("h").alias("subroot"))
    ways = _descend(runs, tops.join(subroots.select("own", "depth"), "own")).withColumnRenamed("at", "block")
    kinds = "doc_id string, leaf string, subroot string, proof_sha256 string, folded_root string" + (", proof array<struct<before:string,after:string>>" if with_proof else "")
    left = placed.select("own", "block", "at", F.col("id").cast("string").alias("doc_id"), "leaf", "altered", "total").groupBy("own", "block")
    found = left.cogroup(ways.groupBy("own", "block")).applyInPandas(lambda key, a, b: _finish(key, a, b, with_proof), kinds)
    made = found.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("root", F.lit(root["h"] if root else None).cast("string"))
    return made.withColumn("verified", F.col("folded_root") == F.col("root")).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", *(["proof"] if with_proof else []))
