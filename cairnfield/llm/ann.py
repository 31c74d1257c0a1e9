"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

The trees are fit on a bounded sample and broadcast. Every row is put into its
leaf of every tree. A query searches all trees through one priority queue,
ordered by the smallest margin on the way to a node, and visits leaves until it
has met enough rows; it is then sent to those leaves, where all rows are scored
exactly. How many rows are enough is found at fit time: the least effort that
reaches the target recall against brute force inside the sample.

One more coordinate, the square root of (largest norm squared - norm squared),
makes the largest inner product the nearest vector.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, smallest
from .jaccard import _runs

TREES, LEAF = 20, 128
#: Rows that the trees are fit on, at most: those with the smallest hash of vec_id. All rows are indexed.
FIT_ROWS = 20_000
#: Recall that the search effort is set for, on the sample.
TARGET = 0.95
#: Rows of one leaf that are scored in one go; a larger leaf is dealt into blocks, each searched.
BLOCK = 4096


@dataclass
class Forest:
    """Nodes of all trees: plane and offset, and children (>= 0: node; < 0: leaf -1 - child)."""

    planes: np.ndarray
    offsets: np.ndarray
    left: np.ndarray
    right: np.ndarray
    roots: np.ndarray
    leaves: int
    top: float  # largest norm
    effort: float = 1.0

    def lift(self, x: np.ndarray, query: bool) -> np.ndarray:
        norm2 = np.einsum("ij,ij->i", x, x)
        if query:
            return np.c_[x / np.sqrt(np.maximum(norm2, 1e-300))[:, None], np.zeros(len(x))]
        return np.c_[x, np.sqrt(np.maximum(self.top**2 - norm2, 0))] / self.top

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each (lifted) row in each tree."""
        out = np.empty((len(x), len(self.roots)), np.int32)
        for t, root in enumerate(self.roots):
            at = np.full(len(x), root, np.int32)
            live = np.flatnonzero(at >= 0)
            while len(live):
                node = at[live]
                side = np.einsum("ij,ij->i", x[live], self.planes[node]) > self.offsets[node]
                at[live] = np.where(side, self.left[node], self.right[node])
                live = live[at[live] >= 0]
            out[:, t] = -1 - at
        return out

    def order(self, margins: np.ndarray, sizes: np.ndarray, enough: float) -> list[int]:
        """Leaves in the order of the shared queue, until they hold `enough` rows. margins: of one query at each node."""
        queue = [(-np.inf, int(r)) for r in self.roots]
        heapq.heapify(queue)
        got, met = [], 0
        while queue and met < enough:
            p, at = heapq.heappop(queue)
            if at < 0:
                got.append(-1 - at)
                met += sizes[-1 - at]
                continue
            m = float(margins[at])
            heapq.heappush(queue, (max(p, -m), int(self.left[at])))
            heapq.heappush(queue, (max(p, m), int(self.right[at])))
        return got


def grow(x: np.ndarray, top: float, trees: int = TREES, leaf: int = LEAF, seed: int = 5) -> Forest:
    """Trees over the rows of x. A plane halves its rows between two means; rows that no plane parts stay one leaf."""
    draw = np.random.default_rng(seed)
    f = Forest(np.zeros((0, x.shape[1] + 1)), np.zeros(0), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32), 0, top)
    x = f.lift(x, False)
    planes, offsets, left, right, roots = [], [], [], [], []
    leaves = 0
    for _ in range(trees):
        stack: list[tuple[np.ndarray, int, int]] = [(np.arange(len(x)), -1, 0)]
        root = None
        while stack:
            rows, parent, side = stack.pop()
            found = None
            if len(rows) > leaf:
                some = x[draw.choice(rows, min(len(rows), 256), replace=False)]
                a, b = some[0], some[int(np.argmax(((some - some[0]) ** 2).sum(1) * draw.random(len(some))))]
                for _ in range(4):
                    near = some @ (a - b) > 0.5 * (a @ a - b @ b)
                    if near.all() or not near.any():
                        break
                    a, b = some[near].mean(0), some[~near].mean(0)
                w = a - b
                if (n := np.linalg.norm(w)) > 1e-9:
                    w = w / n
                    value = x[rows] @ w
                    o = float(np.median(value))
                    above = value > o
                    if above.any() and not above.all():
                        found = (w, o, rows[above], rows[~above])
            if found is None:
                name, leaves = -1 - leaves, leaves + 1
            else:
                name = len(planes)
                planes.append(found[0])
                offsets.append(found[1])
                left.append(0)
                right.append(0)
                stack += [(found[2], name, 0), (found[3], name, 1)]
            if parent < 0:
                root = name
            else:
                (right if side else left)[parent] = name
        roots.append(root)
    width = x.shape[1]
    return Forest(np.array(planes).reshape(-1, width), np.array(offsets), np.array(left, np.int32), np.array(right, np.int32), np.array(roots, np.int32), leaves, top)


def calibrate(f: Forest, x: np.ndarray, k: int, target: float, queries: int = 200) -> float:
    """The least effort (rows met, as a share of all rows; copies in several trees count again) that reaches the target recall in the sample."""
    at = f.leaf_of(f.lift(x, False))
    sizes = np.bincount(at.ravel(), minlength=f.leaves)
    rows_of = [[] for _ in range(f.leaves)]
    for t in range(at.shape[1]):
        order = np.argsort(at[:, t], kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(at[order, t])) + 1):
            if len(part):
                rows_of[at[part[0], t]] = part
    some = np.linspace(0, len(x) - 1, min(queries, len(x))).astype(int)
    margins = f.lift(x[some], True) @ f.planes.T - f.offsets if len(f.planes) else np.zeros((len(some), 0))
    efforts = np.array([0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8, 1, 1.5, 2, 3, 5, 8, 12, len(f.roots) + 1])
    got = np.zeros(len(efforts))
    for i, q in enumerate(some):
        score = x @ x[q]
        score[q] = -np.inf
        true = np.argsort(-score, kind="stable")[: min(k, len(x) - 1)]
        met_at = np.full(len(x), np.inf)
        met = 0
        for leaf in f.order(margins[i], sizes, np.inf):
            new = rows_of[leaf]
            if len(new):
                met_at[new] = np.minimum(met_at[new], met)
            met += sizes[leaf]
        got += (met_at[true][None, :] < efforts[:, None] * len(x)).mean(1) if len(true) else 1
    ok = np.flatnonzero(got / max(1, len(some)) >= target)
    return float(efforts[ok[0]] if len(ok) else efforts[-1])


def _vectors(column: Column, dims: int) -> Column:
    """True for vectors of this many finite components that are not all zero."""
    good = F.forall(column, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return column.isNotNull() & (F.size(column) == dims) & F.coalesce(good, F.lit(False)) & F.exists(column, lambda v: v != 0)


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), float).reshape(len(column), -1)


def _place(batches, sent, blocks):
    """Row -> one row for each tree: (bucket, kind 0, vec_id, vector)."""
    f, n_blocks = sent.value, blocks.value if blocks else None
    for batch in batches:
        x = _matrix(batch.column("vector"))
        leaf = f.leaf_of(f.lift(x, False))
        if n_blocks is None:
            yield pa.RecordBatch.from_arrays([pa.array(leaf.ravel(), pa.int64())], ["leaf"])
            continue
        ids = batch.column("vec_id").to_numpy()
        for t in range(leaf.shape[1]):
            bucket = leaf[:, t].astype(np.int64) << 32 | (ids % n_blocks[leaf[:, t]])
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(np.zeros(len(ids), np.int32)), batch.column("vec_id"), batch.column("vector")], ["bucket", "kind", "vec_id", "vector"])


def _visit(batches, sent, sizes, blocks, enough: float):
    """Query -> one row for each block of each leaf that it visits: (bucket, kind 1, vec_id, vector)."""
    f, sizes, n_blocks = sent.value, sizes.value, blocks.value
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            x = f.lift(_matrix(part.column("vector")), True)
            margins = x @ f.planes.T - f.offsets if len(f.planes) else np.zeros((len(x), 0))
            row, bucket = [], []
            for i in range(len(x)):
                for leaf in f.order(margins[i], sizes, enough):
                    for b in range(n_blocks[leaf]):
                        row.append(i)
                        bucket.append(leaf << 32 | b)
            take = pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(np.ones(len(row), np.int32)), part.column("vec_id").take(take), part.column("vector").take(take)], ["bucket", "kind", "vec_id", "vector"])


def _best(ids: np.ndarray, scores: np.ndarray, k: int):
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    first = np.unique(ids, return_index=True)[1]
    first.sort()
    return ids[first[:k]], scores[first[:k]]


def _score(batches, k: int):
    """For each query in a bucket its k best rows there, exactly scored."""
    for table in _runs(batches, "bucket"):
        key, kind, ids = (table.column(n).to_numpy() for n in ("bucket", "kind", "vec_id"))
        x = _matrix(table.column("vector").combine_chunks())
        bounds = np.r_[np.flatnonzero(np.r_[True, key[1:] != key[:-1]]), len(key)]
        q_out, id_out, s_out = [], [], []
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            rows, asks = s + np.flatnonzero(kind[s:e] == 0), s + np.flatnonzero(kind[s:e] == 1)
            if not len(rows) or not len(asks):
                continue
            v, names = x[rows], ids[rows]
            for a in range(0, len(asks), 256):
                some = asks[a : a + 256]
                rough = x[some] @ v.T
                for i, q in enumerate(some):
                    r = rough[i]
                    r[names == ids[q]] = -np.inf
                    near = np.flatnonzero(np.isfinite(r))
                    if len(near) > k:
                        bound = np.partition(r, len(r) - k)[len(r) - k]
                        near = np.flatnonzero(r >= bound - 1e-9 * max(1.0, abs(bound)))
                    # summed row by row in one fixed order, so equal vectors get equal scores wherever they lie
                    exact = (v[near] * x[q]).sum(1)
                    best = _best(names[near], exact, k)
                    q_out.append(ids[q])
                    id_out.append(best[0])
                    s_out.append(best[1])
        if q_out:
            yield pa.RecordBatch.from_arrays([pa.array(q_out, pa.int64()), pa.array(id_out, pa.list_(pa.int64())), pa.array(s_out, pa.list_(pa.float64()))], ["query_id", "ids", "scores"])


def _merge(batches, k: int):
    for table in _runs(batches, "query_id"):
        key = table.column("query_id").to_numpy()
        bounds = np.r_[np.flatnonzero(np.r_[True, key[1:] != key[:-1]]), len(key)]
        ids, scores = table.column("ids").combine_chunks(), table.column("scores").combine_chunks()
        out = []
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            best = _best(ids.slice(s, e - s).flatten().to_numpy(), scores.slice(s, e - s).flatten().to_numpy(), k)
            out += [(key[s], i + 1, int(v), float(w)) for i, (v, w) in enumerate(zip(*best, strict=True))]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.float64()))], ["query_id", "rank", "vec_id", "score"])


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, vector: str = "embedding", fit_rows: int = FIT_ROWS, trees: int = TREES, leaf: int = LEAF, target: float = TARGET) -> DataFrame:
    """For each query row its k nearest other rows by inner product: query_id, rank (from 1), vec_id, score.

    Ties go to the smaller vec_id; with fewer than k candidates all are given.
    Rows with a null id, and vectors that are null, zero, of another length than
    the sample's first, or hold null or non-finite components take no part. Rows
    that repeat a vec_id count once. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    ship(spark)
    schema = "query_id long, rank int, vec_id long, score double"
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("_asks")).where("vec_id is not null")
    dims = base.where(_vectors(F.col("vector"), F.size("vector"))).agg(F.min_by(F.size("vector"), F.xxhash64("vec_id"))).first()[0]
    if dims is None:
        return spark.createDataFrame([], schema)
    base = base.where(_vectors(F.col("vector"), dims))
    top = float(base.agg(F.max(F.aggregate("vector", F.lit(0.0), lambda a, v: a + v * v))).first()[0]) ** 0.5
    sample = np.array([r[0] for r in smallest(base, F.xxhash64("vec_id"), fit_rows).select("vector").collect()], float)
    f = grow(sample, top, trees, leaf)
    f.effort = calibrate(f, sample, k, target)
    sent = spark.sparkContext.broadcast(f)  # its size follows fit_rows, not the table
    counts = base.select("vec_id", "vector").mapInArrow(lambda it: _place(it, sent, None), "leaf long").groupBy("leaf").count().collect()  # a row for each leaf
    sizes = np.zeros(f.leaves, np.int64)
    for r in counts:
        sizes[r["leaf"]] = r["count"]
    rows = int(sizes.sum()) // trees
    blocks = spark.sparkContext.broadcast(np.maximum(1, -(-sizes // BLOCK)))
    size_of = spark.sparkContext.broadcast(sizes)
    kinds = "bucket long, kind int, vec_id long, vector array<double>"
    index = base.select("vec_id", "vector").mapInArrow(lambda it: _place(it, sent, blocks), kinds)
    asked = base.where("_asks").select("vec_id", "vector").mapInArrow(lambda it: _visit(it, sent, size_of, blocks, f.effort * rows), kinds)
    met = index.unionByName(asked).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lambda it: _score(it, k), "query_id long, ids array<long>, scores array<double>")
    return met.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(lambda it: _merge(it, k), schema)
