"""Secret scans over every version of every path, each distinct text scanned once.

A version's text is a blob, named by its SHA-256. The ledger holds one row for
each (blob, rule version) that has been scanned; only pairs that it lacks are
scanned. Findings belong to blobs and are joined back to all paths.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, slices
from ..operators.graph import spread_join


@dataclass(frozen=True)
class Rule:
    """A kind of secret: every leftmost match of `pattern` that does not overlap the one before counts if `group` has `least` characters."""

    kind: str  # one rule of a set for each
    version: int
    pattern: str
    group: int
    least: int
    flags: int = re.ASCII


# Kinds, patterns and least lengths, in the order that breaks ties.
RULES = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, re.ASCII | re.IGNORECASE),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", 1, r"[0-9a-f]+", 0, 16),
)

_FOUND = "array<struct<kind:string,start:long,end:long>>"
LEDGER = f"blob string, rule string, found {_FOUND}"


def rule_name(r: Rule) -> str:
    """Name of a rule at its version; with the blob it is the ledger's key. What it looks for is part of the name, so a change without a new version is none the less a new rule."""
    return f"{r.kind}@{r.version}:" + hashlib.sha256(f"{r.flags}:{r.group}:{r.least}:{r.pattern}".encode()).hexdigest()[:16]


def matches(text: str, rule: Rule) -> list[tuple[int, int]]:
    """(start, end) in code points of a rule's matches, in order."""
    pattern = rule.pattern
    if rule.group == 0 and rule.pattern.endswith("]+"):
        pattern = f"{rule.pattern[:-1]}{{{rule.least},}}" if rule.pattern.startswith("[") else rule.pattern  # runs of one class: a shorter run can't hold a longer one
    return [m.span() for m in re.compile(pattern, rule.flags).finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def _scan(batches, rules: tuple[Rule, ...]):
    """A ledger row for each blob and each of the rules that its row lists in `missing`."""
    by_name = {rule_name(r): r for r in rules}
    schema = pa.schema([("blob", pa.string()), ("rule", pa.string()), ("found", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))])
    for part in slices(batches, "text"):
        blobs, names, found = [], [], []
        for blob, text, missing in zip(part.column("blob").to_pylist(), part.column("text").to_pylist(), part.column("missing").to_pylist(), strict=True):
            for name in missing:
                rule = by_name[name]
                blobs.append(blob)
                names.append(name)
                found.append([{"kind": rule.kind, "start": a, "end": b} for a, b in matches(text or "", rule)])
        yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.string()), pa.array(names, pa.string()), pa.array(found, schema.field("found").type)], schema=schema)


def versions_of(docs: DataFrame, path: str = "doc_id", history: tuple[str, ...] = ()) -> DataFrame:
    """(path, blob, text) and the columns of history (such as a commit): one row per version of a path, its text named by content. Null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col(path).alias("path"), *history, F.sha2(text.cast("binary"), 256).alias("blob"), text.alias("text"))


def scan_unseen(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows (blob, rule, found) for the pairs of blob and rule version that `ledger` lacks.

    A blob is read once however many versions hold it: copies fall together
    before the shuffle. Pairs without findings get a row too (found is empty).
    """
    ship(versions.sparkSession)
    every = F.array(*[F.lit(rule_name(r)) for r in rules])
    blobs = versions.select("blob", "text").groupBy("blob").agg(F.first("text").alias("text"))
    if ledger is None:
        blobs = blobs.withColumn("missing", every)
    else:
        # a handful of names for each blob
        seen = ledger.where(F.col("rule").isin([rule_name(r) for r in rules])).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        blobs = blobs.join(seen, "blob", "left").withColumn("missing", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>")))).drop("seen").where(F.size("missing") > 0)
    return blobs.mapInArrow(lambda it: _scan(it, rules), LEDGER)


def findings_of(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """versions less text, with found: what the ledger holds of their blobs under these rules, by start, then rule in the order given."""
    turn = F.create_map(*[v for i, r in enumerate(rules) for v in (F.lit(r.kind), F.lit(i))])
    held = ledger.where(F.col("rule").isin([rule_name(r) for r in rules]) & (F.size("found") > 0)).dropDuplicates(["blob", "rule"])
    # found by a few rules, so a few lists for each blob
    held = held.groupBy("blob").agg(F.flatten(F.collect_list("found")).alias("found"))
    keyed = F.sort_array(F.transform("found", lambda x: F.struct(x["start"].alias("start"), F.element_at(turn, x["kind"]).alias("turn"), x.alias("x"))))
    held = held.select("blob", F.transform(keyed, lambda k: k["x"]).alias("found"))
    met = spread_join(versions.drop("text"), held, "blob", "left")
    return met.withColumn("found", F.coalesce("found", F.array().cast(_FOUND)))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger that lies at path; an empty one if there is none yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def scan_secrets(docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings of every document: (path, blob, found), by way of the ledger at `path`: pairs of blob and rule version that it lacks are scanned and appended. Documents are named by doc_id.

    Null text counts as empty; every row is answered, repeated rows too; other
    columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    versions = versions_of(docs)
    held = read_ledger(spark, path)
    scan_unseen(versions, None if held.isEmpty() else held, rules).write.mode("append").parquet(path)
    return findings_of(versions, read_ledger(spark, path), rules)


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, a count for each kind, base_sha256 and spans of scan_secrets' rows."""
    spans = F.array_join(F.transform("found", lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(F.col("path").alias("doc_id"), *[count(r.kind) for r in rules], F.sha2(spans.cast("binary"), 256).alias("base_sha256"), spans.alias("spans"))
