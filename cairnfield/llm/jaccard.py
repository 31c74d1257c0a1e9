"""Jaccard join on word shingles by chosen paths.

Each text is the set of its runs of five words, and a sketch of that set: the
smallest members under fixed hash functions, which are tokens that similar sets
share. A path chooses a coordinate and follows the token found there, so sets
that share it meet in a bucket. Buckets that stay large are split again on other
chosen coordinates; small ones are compared whole. Independent choices at each
level repeat the run until a pair at the threshold is missed with a probability
under `miss`. Candidates fall into groups; inside each group all pairs are
verified on the whole sets.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import cut, probably_in, ship, slices, text_buffers
from ..operators.graph import components

#: Coordinates of a sketch; rows of a bucket whose sketches, and whose whole sets, are compared in one go.
SKETCH, BLOCK, WHOLE_BLOCK = 64, 4096, 1024
_draw = np.random.default_rng(20240229)
_MULTIPLIERS = _draw.integers(1, 2**63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(part, size: int):
    """Distinct hashed runs of `size` words of each text; a shorter text is one run; a text without words has none."""
    data, offsets = text_buffers(part.column("text"))
    starts, ends, first = words.spans(data, offsets)
    each = words.hashes(data, starts, ends)
    hashed, at = words.windows(each, first, size)
    bounds = np.searchsorted(at, first)
    for i in range(len(offsets) - 1):
        if bounds[i + 1] > bounds[i]:
            yield np.unique(hashed[bounds[i] : bounds[i + 1]])
        elif first[i + 1] > first[i]:
            own = each[first[i] : first[i + 1]]
            yield words.mix(words.prefix_sums(own, words._B)[-1:] + np.uint64(len(own)), 40)
        else:
            yield each[:0]


def sketch(own: np.ndarray) -> np.ndarray:
    """Low bits of the smallest member under each hash function."""
    out = np.empty(SKETCH, np.uint16)
    for a in range(0, SKETCH, 16):
        h = own[None, :] * _MULTIPLIERS[a : a + 16, None]
        h ^= h >> np.uint64(32)
        out[a : a + 16] = (h.min(1) >> np.uint64(20)).astype(np.uint16)
    return out


def set_name(own: np.ndarray) -> int:
    """A number for a set, the same for equal sets."""
    total = int(words.mix(own, 41).sum(dtype=np.uint64)) if len(own) else 0
    return int(words.mix(np.array([total ^ len(own)], np.uint64), 42).view(np.int64)[0])


def _sketches(batches, size: int):
    for part in slices(batches, "text"):
        name, n, low = [], [], []
        for own in shingles(part, size):
            name.append(set_name(own) if len(own) else None)
            n.append(len(own))
            low.append(sketch(own).tobytes() if len(own) else None)
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("mark"), pa.array(name, pa.int64()), pa.array(n, pa.int64()), pa.array(low, pa.binary())], ["doc_id", "mark", "name", "size", "sketch"])


def _runs(batches, key: str):
    """Whole groups of rows with equal keys, from batches sorted by key; several groups at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy()
        if held and held[-1].column(key)[held[-1].num_rows - 1].as_py() != k[0]:
            yield pa.Table.from_batches(held)
            held = []
        last = int(np.searchsorted(k, k[-1], "left")) if k[0] <= k[-1] and np.all(k[1:] >= k[:-1]) else int(np.flatnonzero(np.r_[True, k[1:] != k[:-1]])[-1])
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots (smallest index) after tying a[i] to b[i]."""
    while True:
        x, y = parent[a], parent[b]
        if np.array_equal(x, y):
            return parent
        low = np.minimum(x, y)
        np.minimum.at(parent, x, low)
        np.minimum.at(parent, y, low)
        while not np.array_equal(parent, parent[parent]):
            parent = parent[parent]


def _edges_of(names: np.ndarray, pairs) -> tuple[np.ndarray, np.ndarray]:
    """A forest over `names` that connects what the pairs connect."""
    a, b = pairs
    if not len(a):
        return names[:0], names[:0]
    parent = _union(np.arange(len(names)), a, b)
    moved = np.flatnonzero(parent != np.arange(len(names)))
    return names[moved], names[parent[moved]]


def _compare(batches, least: float, ratio: float):
    """Candidate edges of each bucket: sketches that agree in `least` of all coordinates, sizes no further apart than `ratio`."""
    tied: dict[int, int] = {}  # what the task has tied so far: an edge that ties nothing new is not sent

    def root(x: int) -> int:
        while (up := tied.get(x, x)) != x:
            tied[x] = x = tied.get(up, up)
        return x

    for table in _runs(batches, "bucket"):
        key = table.column("bucket").to_numpy()
        names, sizes, side = table.column("name").to_numpy(), table.column("size").to_numpy(), table.column("side").to_numpy()
        low = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint16).reshape(-1, SKETCH)
        bounds = np.r_[np.flatnonzero(np.r_[True, key[1:] != key[:-1]]), len(key)]
        us, vs = [], []
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if e - s < 2:
                continue
            own, mine = low[s:e], sizes[s:e]
            a, b = [], []
            for i in range(e - s - 1):
                ok = ((own[i + 1 :] == own[i]).sum(1) >= least * SKETCH) & (np.minimum(mine[i + 1 :], mine[i]) >= ratio * np.maximum(mine[i + 1 :], mine[i]))
                if side[s] >= 0:
                    ok &= side[s + i + 1 : e] != side[s + i]
                j = np.flatnonzero(ok) + i + 1
                a.append(np.full(len(j), i))
                b.append(j)
            for u, v in zip(*(x.tolist() for x in _edges_of(names[s:e], (np.concatenate(a), np.concatenate(b)))), strict=True):
                x, y = root(u), root(v)
                if x != y:
                    tied[max(x, y)] = min(x, y)
                    us.append(u)
                    vs.append(v)
        if us:
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["a", "b"])


def _coordinate(bucket, turn: int, tries: int):
    """The coordinate that a path chooses at its next step, for its try number `turn`: all different within a bucket."""
    return F.pmod(F.pmod(F.xxhash64(bucket), F.lit(SKETCH)) + F.lit(turn * (SKETCH // tries)), F.lit(SKETCH)).cast("int")


def _token(coordinate):
    return F.substring(F.col("sketch"), coordinate * 2 + 1, F.lit(2))


def paths(sets: DataFrame, tries: int, levels: int, block: int = BLOCK) -> DataFrame:
    """Rows (bucket, side, name, size, sketch): every bucket of two sets or more, none with more than about two blocks of rows.

    A bucket that stays large after all levels is dealt into pairs of blocks,
    so all its pairs meet still; side tells the two blocks of such a pair apart
    (-1: compare all).
    """
    done = None
    state = sets.withColumn("bucket", F.lit(0).cast("long"))
    for level in range(levels):
        rows = state.select("name", "size", "sketch", F.explode(F.array(*[F.struct(F.lit(t).alias("t"), _coordinate("bucket", t, tries).alias("c")) for t in range(tries)])).alias("x"), "bucket")
        rows = rows.select(F.xxhash64("bucket", "x.c", _token(F.col("x.c"))).alias("bucket"), "name", "size", "sketch")
        n = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        rows = rows.join(n, "bucket")
        last = level == levels - 1
        small = rows.where(F.col("n") <= block).select("bucket", F.lit(-1).alias("side"), "name", "size", "sketch")
        done = small if done is None else done.unionByName(small)
        large = rows.where(F.col("n") > block)
        if not last:
            state = cut(large.select("name", "size", "sketch", "bucket"))
            if state.isEmpty():
                return done
            continue
        done = done.unionByName(_block_pairs(large, block).select("bucket", "side", "name", "size", "sketch"))
    return done


def _block_pairs(large: DataFrame, block: int) -> DataFrame:
    """Each row once for every pair of blocks that its own block is in. Needs bucket, n and name."""
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = large.withColumn("_own", F.pmod(F.xxhash64("name", "bucket"), blocks).cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    pair = F.xxhash64("bucket", F.least("_own", "_other"), F.greatest("_own", "_other"))
    side = F.when(F.col("_own") == F.col("_other"), F.lit(-1)).when(F.col("_own") < F.col("_other"), F.lit(0)).otherwise(F.lit(1))
    return own.withColumn("bucket", pair).withColumn("side", side).drop("_own", "_other", "n")


def _sets(batches, size: int):
    for part in slices(batches, "text"):
        got = [own.tobytes() for own in shingles(part, size)]
        rest = [n for n in part.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([part.column(n) for n in rest] + [pa.array(got, pa.binary())], [*rest, "members"])


def _verify(batches, threshold: float):
    """Exact links inside each bucket. Rows (a, links, b): links of set a in this bucket, counting copies; b: what a is tied to, if anything smaller."""
    for table in _runs(batches, "bucket"):
        key, side = table.column("bucket").to_numpy(), table.column("side").to_numpy()
        names, copies = table.column("name").to_numpy(), table.column("copies").to_numpy()
        blobs = table.column("members").to_pylist()
        bounds = np.r_[np.flatnonzero(np.r_[True, key[1:] != key[:-1]]), len(key)]
        out: list[tuple] = []
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            sizes = np.array([len(b) // 8 for b in blobs[s:e]])
            # ascending sizes, so that the partners of a set lie together
            order = np.argsort(sizes, kind="stable")
            sizes = sizes[order]
            flat = np.frombuffer(b"".join([blobs[s + i] for i in order]), np.uint64)
            number = np.unique(flat, return_inverse=True)[1]
            ends = np.cumsum(sizes)
            marked = np.zeros(number.max() + 1 if len(number) else 1, bool)
            own, mine, sided = names[s:e][order], copies[s:e][order], side[s:e][order]
            links = np.zeros(e - s, np.int64)
            a, b = [], []
            for i in range(e - s - 1):
                top = int(np.searchsorted(sizes, sizes[i] / threshold + 1e-9, "right"))
                if top <= i + 1:
                    continue
                members = number[ends[i] - sizes[i] : ends[i]]
                marked[members] = True
                at = ends[i]
                shared = np.add.reduceat(marked[number[at : ends[top - 1]]], ends[i : top - 1] - at, dtype=np.int64)
                marked[members] = False
                ok = shared >= threshold * (sizes[i] + sizes[i + 1 : top] - shared) - 1e-9
                if side[s] >= 0:
                    ok &= sided[i + 1 : top] != sided[i]
                j = np.flatnonzero(ok) + i + 1
                links[i] += mine[j].sum()
                links[j] += mine[i]
                a.append(np.full(len(j), i))
                b.append(j)
            if not a:
                continue
            parent = _union(np.arange(e - s), np.concatenate(a), np.concatenate(b))
            for i in np.flatnonzero(links):
                out.append((int(own[i]), int(links[i]), int(own[parent[i]])))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(3)], ["a", "links", "b"])


def similar_classes(docs: DataFrame, size: int = 5, threshold: float = 0.8, miss: float = 1e-5, block: int = BLOCK, firsts: bool = False) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id that it is connected with), n_links (other documents whose similarity is `threshold` or more).

    Similarity is the Jaccard index of the sets of runs of `size` words (divided
    by the six ASCII spaces, otherwise as they are); a text with fewer words is
    one run. Equal sets count as links of each other. Null, empty and blank
    texts have no links and are their own class. Rows that repeat a doc_id are
    answered each. An empty table gives an empty result. With firsts there are
    two columns more: mark (xxhash64 of the text) and first, whether (doc_id,
    mark) is the smallest of the class, rows without a doc_id last.
    """
    ship(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("mark"))
    sketched = cut(base.mapInArrow(lambda it: _sketches(it, size), "doc_id long, mark long, name long, size long, sketch binary"))
    # equal sets fall together before anything is compared; one text stands for each
    sets = cut(sketched.where("name is not null").groupBy("name").agg(F.min("doc_id").alias("least"), F.min(_order()).alias("lead"), F.min(F.struct("doc_id", "mark")).alias("one"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"), F.first("sketch").alias("sketch")))
    tries = next(t for t in (2, 4, 8, 16, 32) if (1 - threshold) ** t <= miss)
    spread = math.sqrt(threshold * (1 - threshold) / SKETCH)
    found = paths(sets.select("name", "size", "sketch"), tries, 2, block)
    near = found.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lambda it: _compare(it, threshold - 4.3 * spread, threshold), "a long, b long")
    groups = components(near)
    counted = groups.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    mates = cut(groups.join(counted, "root").join(sets.select("name", "copies", "one"), F.col("node") == F.col("name")).select("name", "copies", "one", F.col("root").alias("bucket"), "n"))
    # whole sets, of those that have a candidate only
    picked = mates.select("name", F.col("one.doc_id").alias("p_id"), F.col("one.mark").alias("p_mark"))
    texts = probably_in(base, picked, ["doc_id", "mark"], ["p_id", "p_mark"]).join(picked, F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("mark") == F.col("p_mark"))).select("name", "text")
    whole = texts.mapInArrow(lambda it: _sets(it, size), "name long, members binary").groupBy("name").agg(F.first("members").alias("members"))
    mates = mates.drop("one")
    rows = mates.join(whole, "name")
    small = rows.where(F.col("n") <= WHOLE_BLOCK).select("bucket", F.lit(-1).alias("side"), "name", "copies", "members")
    large = _block_pairs(rows.where(F.col("n") > WHOLE_BLOCK), WHOLE_BLOCK).select("bucket", "side", "name", "copies", "members")
    exact = cut(small.unionByName(large).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lambda it: _verify(it, threshold), "a long, links long, b long"))
    linked = exact.groupBy("a").agg(F.sum("links").alias("links"))
    roots = components(exact.select("a", "b"))
    named = sets.select("name", "least", "lead", "copies").join(linked.withColumnRenamed("a", "name"), "name", "left").join(roots.withColumnRenamed("node", "name"), "name", "left").select("name", "least", "lead", F.coalesce("root", "name").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    classes = named.groupBy("root").agg(F.min("least").alias("class_id"), F.min("lead").alias("lead"))
    named = named.select("name", "root", "n_links").join(classes, "root").select("name", "class_id", "lead", "n_links")
    found = sketched.select("doc_id", "mark", "name").join(named, "name", "left")
    columns = ["doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")]
    if firsts:
        columns += ["mark", (F.col("lead").isNull() | _order().eqNullSafe(F.col("lead"))).alias("first")]
    return found.select(*columns)


def _order():
    return F.struct(F.col("doc_id").isNull().alias("without"), F.col("doc_id").alias("doc_id"), F.col("mark").alias("mark"))
