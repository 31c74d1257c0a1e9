"""Hard negatives by bounds along a spanning tree of the anchors.

Anchors are dealt into blocks of like ones, and each block gets a minimum
spanning tree. A candidate x whose score with a parent anchor p lies in
[low, high] has a score with the child c in [low - d |x|, high + d |x|], d being
the length of the edge, so only candidates whose interval meets the window that
is still open are scored again; the others keep the interval for the next edge.
Scores of the root are exact for all.

Anchors and candidates meet in a grid of cells: candidates are dealt by hash
into columns, blocks of anchors into rows, and each cell holds a bounded part of
both. It gives what is best inside it, and a ranked window merges the cells.
The work grows with anchors times rows, as every anchor asks all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranks import ranked
from .common import ship, stored

#: Anchors of a tree, candidates that one walk scores, bytes of vectors of a cell on each side, least number of columns.
BLOCK, WALK, CELL_BYTES, COLUMNS = 256, 4096, 64 << 20, 16
#: Scores under this are exact as doubles.
EXACT = 2.0**52
LONG = 2**63


def tree_of(x: np.ndarray) -> list[tuple[int, int, float]]:
    """(row, parent row or -1, length of the edge) of a minimum spanning tree over the rows of x, parents first and each child's own children before the next child."""
    n = len(x)
    squares = (x * x).sum(1)
    near, parent = np.full(n, np.inf), np.full(n, -1)
    children: list[list[int]] = [[] for _ in range(n)]
    out, now = np.zeros(n, bool), 0
    for _ in range(n - 1):
        out[now] = True
        d = squares + squares[now] - 2 * (x @ x[now])
        closer = (d < near) & ~out
        near[closer], parent[closer] = d[closer], now
        now = int(np.argmin(np.where(out, np.inf, near)))
        children[parent[now]].append(now)
    walk, open_ = [], [0] if n else []
    while open_:
        i = open_.pop()
        walk.append((i, int(parent[i]), float(np.sqrt(((x[i] - x[parent[i]]) ** 2).sum())) if parent[i] >= 0 else 0.0))
        open_ += children[i]
    return walk


def _scores(x: np.ndarray, a: np.ndarray, safe: bool) -> np.ndarray:
    """Inner products of the rows of x with a as 64-bit integers; what is beyond them counts as the last one."""
    if safe:
        return (x @ a).astype(np.int64)
    b = [int(v) for v in a.tolist()]
    return np.array([min(LONG - 1, max(-LONG, sum(int(u) * v for u, v in zip(row, b, strict=True)))) for row in x.tolist()], np.int64)


def walk_tree(tree, anchors: np.ndarray, x: np.ndarray, norms: np.ndarray, safe: bool, wanted, take) -> int:
    """Score candidates x along the tree. wanted(anchor, low, high): which may matter; take(anchor, rows, scores): exact scores of those. Gives how many pairs were scored."""
    held: dict[int, tuple] = {}
    left = np.zeros(len(anchors), int)
    for _, parent, _ in tree:
        if parent >= 0:
            left[parent] += 1
    scored = 0
    for i, parent, edge in tree:
        if parent < 0 or not safe:
            low = high = np.zeros(0)
            rows = np.arange(len(x))
        else:
            # a little more than the bound, for the rounding of lengths
            reach = edge * norms * (1 + 1e-12) + 1e-6
            low, high = held[parent][0] - reach, held[parent][1] + reach
            rows = np.flatnonzero(wanted(i, low, high))
            left[parent] -= 1
            if not left[parent]:
                del held[parent]
        scored += len(rows)
        exact = _scores(x if len(rows) == len(x) else x[rows], anchors[i], safe)
        take(i, rows, exact)
        if left[i] and safe:
            if len(rows) == len(x):
                low = high = exact.astype(float)
            else:
                low[rows] = high[rows] = exact
            held[i] = (low, high)
    return scored


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by smaller id."""
    at = np.arange(len(scores))
    if len(at) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return at[np.lexsort((ids[at], ~scores[at]))[:k]]  # ~s falls as s rises, and has no overflow


class _Top:
    """The best k (score, id) seen so far."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> float:
        return float(self.scores[-1]) if len(self.scores) == self.k else -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(self.scores) == self.k:
            good = scores >= self.scores[-1]
            scores, ids = scores[good], ids[good]
        if len(scores):
            s, i = np.r_[self.scores, scores], np.r_[self.ids, ids]
            keep = _best(s, i, self.k)
            self.scores, self.ids = s[keep], i[keep]


def _matrix(table: pa.Table) -> np.ndarray:
    n = table.num_rows
    values = table.column("q").combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, len(values.flatten()) // n) if n else np.zeros((0, 0))


def _read(table: pa.Table):
    number = lambda c: table.column(c).to_numpy()
    x = _matrix(table)
    return number("vec_id"), number("label"), x, np.sqrt((x * x).sum(1))


def _walks(anchors: pa.Table, rows: pa.Table):
    """(ids, labels, matrix, tree) of each block of anchors, candidates in walks, and whether all scores are exact as doubles."""
    ids, labels, x, norms = _read(rows)
    blocks = []
    for block in np.unique(anchors.column("block").to_numpy()):
        part = anchors.filter(pa.array(anchors.column("block").to_numpy() == block))
        a_ids, a_labels, a, a_norms = _read(part)
        blocks.append((part, a_ids, a_labels, a, a_norms.max(initial=0) * norms.max(initial=0) < EXACT))
    return ids, labels, x, norms, blocks


def _positives(anchors: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """The best k other rows of the same label, for each anchor, inside this cell."""
    ids, labels, x, norms, blocks = _walks(anchors, rows)
    out: list[tuple] = []
    for _, a_ids, a_labels, a, safe in blocks:
        for label in np.unique(a_labels):
            mine, alike = np.flatnonzero(a_labels == label), np.flatnonzero(labels == label)
            tree, tops = tree_of(a[mine]), [_Top(k) for _ in mine]
            for at in range(0, len(alike), WALK):
                some = alike[at : at + WALK]

                def take(i, hit, s, some=some, tops=tops, mine=mine):
                    hit = some[hit]
                    other = ids[hit] != a_ids[mine[i]]
                    tops[i].add(s[other], ids[hit[other]])

                walk_tree(tree, a[mine], x[some], norms[some], safe, lambda i, low, high, tops=tops: high >= tops[i].least(), take)
            out += [(a_ids[mine[i]], top.ids, top.scores) for i, top in enumerate(tops)]
    return pa.table([pa.array(np.concatenate([np.full(len(i), a) for a, i, _ in out]) if out else [], pa.int64()), pa.array(np.concatenate([i for _, i, _ in out]) if out else [], pa.int64()), pa.array(np.concatenate([s for _, _, s in out]) if out else [], pa.int64())], ["anchor_id", "positive_id", "positive_score"])


def _negatives(anchors: pa.Table, rows: pa.Table, k: int, low_share: int, high_share: int) -> pa.Table:
    """For each anchor and positive the best k rows of other labels inside the window, inside this cell."""
    ids, labels, x, norms, blocks = _walks(anchors, rows)
    out: list[tuple] = []
    for part, a_ids, a_labels, a, safe in blocks:
        # all integers: the least and the largest score of the window of each positive
        wins = [[(p["n"], p["id"], p["score"], -(-low_share * p["score"] // 100), high_share * p["score"] // 100) for p in ps] for ps in part.column("positives").to_pylist()]
        tops = [[_Top(k) for _ in w] for w in wins]
        tree = tree_of(a)

        def wanted(i, low, high, some, wins=wins, tops=tops, a_labels=a_labels):
            least, most = np.inf, -np.inf
            for (*_, lo, hi), top in zip(wins[i], tops[i], strict=True):
                if lo <= hi:
                    least, most = min(least, max(lo, top.least())), max(most, hi)
            return (high >= least) & (low <= most) & (labels[some] != a_labels[i])

        for at in range(0, len(ids), WALK):
            some = np.arange(at, min(at + WALK, len(ids)))

            def take(i, hit, s, some=some, wins=wins, tops=tops, a_ids=a_ids, a_labels=a_labels):
                other = (labels[some[hit]] != a_labels[i]) & (ids[some[hit]] != a_ids[i])
                s, names = s[other], ids[some[hit[other]]]
                for (*_, lo, hi), top in zip(wins[i], tops[i], strict=True):
                    inside = (s >= max(lo, top.least())) & (s <= hi)
                    if inside.any():
                        top.add(s[inside], names[inside])

            walk_tree(tree, a, x[some], norms[some], safe, lambda i, low, high, some=some, wanted=wanted: wanted(i, low, high, some), take)
        for i, w in enumerate(wins):
            for (nth, positive, score, _, _), top in zip(w, tops[i], strict=True):
                out += [(int(a_ids[i]), nth, positive, n, score, s) for n, s in zip(top.ids.tolist(), top.scores.tolist(), strict=True)]
    names = ["anchor_id", "nth", "positive_id", "negative_id", "positive_score", "negative_score"]
    return pa.table([pa.array([r[j] for r in out], pa.int64()) for j in range(6)], names)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low_share: int = 50, high_share: int = 95, scale: int = 256, vector: str = "embedding") -> DataFrame:
    """For each anchor and each of its positives the best rows of other labels whose score lies between low_share and high_share percent of the positive's: anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Components x become floor(scale * x); a score is the integer inner product
    with the anchor, and one beyond 64 bits counts as the last number of 64
    bits. Higher scores first, ties by smaller vec_id. Positives are the
    anchor's best other rows of its label. Rows with a null vec_id, label or
    vector, or a null or non-finite component, take no part; vectors of
    different lengths never meet. Rows that repeat a vec_id are candidates
    each, and one anchor (the one with the least label and vector); a row of
    the anchor's own vec_id isn't another row. Other columns are ignored; an
    empty table gives an empty result.
    """
    spark = vectors.sparkSession
    ship(spark)
    v = F.col(vector).cast("array<double>")
    real = ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.when(real, F.transform(v, lambda c: F.floor(F.lit(scale) * c).cast("long"))).alias("q"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    rows = stored(rows.where("vec_id is not null and label is not null and q is not null").withColumn("dims", F.size("q")), "negatives-rows")
    found = rows.groupBy("asks").agg(F.count(F.lit(1)).alias("n"), F.max("dims").alias("d")).collect()
    schema = "anchor_id long, nth long, positive_id long, negative_id long, positive_score long, negative_score long"
    wide = max([8 * max(1, r["d"]) for r in found], default=8)
    columns = max(COLUMNS, -(-sum(r["n"] for r in found) * wide // CELL_BYTES))
    # rows of the grid: 1 until the anchors are more than a cell holds
    lines = max(1, -(-sum(r["n"] for r in found if r["asks"]) * wide // CELL_BYTES))
    each = lambda n: F.explode(F.array([F.lit(i) for i in range(n)])) if n < 64 else F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    column = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(columns)).cast("int")
    candidates = rows.select("vec_id", "label", "q", "dims", column.alias("col")).withColumn("line", each(lines))
    # like anchors stand together: by label, then along one fixed direction
    along = F.aggregate(F.transform("q", lambda c, i: F.when(F.xxhash64(i) % 2 == 0, c).otherwise(-c).cast("double")), F.lit(0.0), lambda a, b: a + b)
    one = rows.where("asks").groupBy("vec_id").agg(F.min(F.struct("label", "q", "dims")).alias("r")).select("vec_id", "r.*")
    anchors = ranked(one.withColumn("along", along), ["dims", "label", "along", "vec_id"]).withColumn("block", F.floor((F.col("rank") - 1) / BLOCK))
    anchors = stored(anchors.select("vec_id", "label", "q", "dims", "block").withColumn("line", F.pmod(F.xxhash64("block"), F.lit(lines)).cast("int")), "negatives-anchors")
    cell = ["line", "col", "dims"]

    def meet(asking: DataFrame, f, kinds: str) -> DataFrame:
        return asking.withColumn("col", each(columns)).groupBy(*cell).cogroup(candidates.groupBy(*cell)).applyInArrow(f, kinds)

    near = meet(anchors, lambda a, b: _positives(a, b, positives), "anchor_id long, positive_id long, positive_score long")
    best = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    chosen = near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= positives)
    # at most `positives` for each anchor
    chosen = chosen.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.array_sort(F.collect_list(F.struct("n", F.col("positive_id").alias("id"), F.col("positive_score").alias("score")))).alias("positives"))
    asking = stored(anchors.join(chosen, "vec_id"), "negatives-asking")
    hard = meet(asking, lambda a, b: _negatives(a, b, negatives, low_share, high_share), schema)
    by = Window.partitionBy("anchor_id", "nth").orderBy(F.col("negative_score").desc(), "negative_id")
    return hard.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
