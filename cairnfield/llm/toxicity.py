"""Toxicity scores from a factorization machine over hashed terms.

Terms are words (ASCII case folded) and word beginnings, known by their hash. Beside its linear weight each term has a short vector; the score adds
the inner products of all pairs of terms of a text, so a pair such as an insult
and the mention of a group counts beyond the sum of the two. The model is fit
on a bounded sample of labelled rows and broadcast; its size is fixed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import ship, slices, smallest, text_buffers

RANK = 6
#: At most this many labelled rows of each class are used to fit (those whose hashed doc_id is smallest).
FIT_ROWS = 4_000
#: Lengths in bytes of the word beginnings that are terms of their own.
HEADS = (4, 6, 8)
#: A term takes part if its shares in the two classes differ by this many standard errors, and this many fitted texts hold it.
LEAST_Z, LEAST_TEXTS = 3.5, 3
#: At most this many terms take part, so the driver gets FIT_ROWS * 2 * MOST_TERMS numbers at the very most, however long the texts are.
MOST_TERMS = 4_000

_GAP = np.ones(256, bool)
_GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def terms(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None):
    """Distinct hashed terms (32 bits) of each text, as (term, text) with text ascending; only those that `wanted` may hold, if given (a table over the low 20 bits)."""
    data = _FOLD[data]
    starts, ends, first = words.spans(data, offsets, _GAP)
    sums = words.prefix_sums(words._BYTE[data], words._P)
    text = np.repeat(np.arange(len(offsets) - 1, dtype=np.uint64), np.diff(first))
    got = []
    for size in (0, *HEADS):
        use = slice(None) if not size else ends - starts > size
        s = starts[use]
        e = ends[use] if not size else s + size
        h = words.mix(words.window_values(sums, s, e, words._P) ^ (e - s).astype(np.uint64), 1 + size) >> np.uint64(32)
        t = text[use]
        if wanted is not None:
            keep = wanted[h & np.uint64(0xFFFFF)]
            h, t = h[keep], t[keep]
        got.append(t << np.uint64(32) | h)
    got = np.unique(np.concatenate(got))
    return (got & np.uint64(0xFFFFFFFF)).astype(np.uint32), (got >> np.uint64(32)).astype(np.int64)


@dataclass
class Machine:
    """bias + sum of w + sum over pairs of <v, v'> over the distinct terms of a text that `names` (ascending) lists."""

    bias: float
    names: np.ndarray
    w: np.ndarray
    v: np.ndarray

    def wanted(self) -> np.ndarray:
        table = np.zeros(1 << 20, bool)
        table[self.names & np.uint32(0xFFFFF)] = True
        return table

    def own(self, term: np.ndarray, text: np.ndarray):
        """Terms as indexes of `names`, without those that are not in it."""
        if not len(self.names):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.names, term), len(self.names) - 1)
        keep = self.names[at] == term
        return at[keep], text[keep]

    def raw(self, term: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        total = np.bincount(text, self.w[term], n)
        for k in range(self.v.shape[1]):
            total = total + 0.5 * (np.bincount(text, self.v[term, k], n) ** 2 - np.bincount(text, self.v[term, k] ** 2, n))
        return self.bias + total

    def score(self, term: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(term, text, n), -30, 30)))


def fit(texts: list[np.ndarray], labels: np.ndarray, names: np.ndarray, rounds: int = 30, rate: float = 0.2, decay: float = 5e-4, weight: float = 3.0, batch: int = 64, seed: int = 7) -> Machine:
    """AdaGrad on the logistic loss; texts: the terms of each that are in names (ascending); weight: how much a row of class 1 counts."""
    draw = np.random.default_rng(seed)
    n1, n0 = int(labels.sum()), int(len(labels) - labels.sum())
    if not n1 or not n0:
        share = (n1 + 0.5) / (n1 + n0 + 1)
        return Machine(float(np.log(share / (1 - share))), np.zeros(0, np.uint32), np.zeros(0), np.zeros((0, RANK)))
    m = Machine(float(np.log(n1 / n0)), names, np.zeros(len(names)), draw.normal(0, 0.01, (len(names), RANK)))
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    term = np.searchsorted(names, np.concatenate(texts))
    bounds = np.searchsorted(text, np.arange(len(texts) + 1))
    gw, gv, gb = np.full(len(m.w), 1e-6), np.full(m.v.shape, 1e-6), 1e-6
    for _ in range(rounds):
        order = draw.permutation(len(texts))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            n = len(pick)
            own = np.concatenate([term[bounds[i] : bounds[i + 1]] for i in pick])
            of = np.repeat(np.arange(n), (bounds[1:] - bounds[:-1])[pick])
            err = (m.score(own, of, n) - labels[pick]) * (1 + (weight - 1) * labels[pick])
            gb += float(err.mean() ** 2)
            m.bias -= rate * float(err.mean()) / np.sqrt(gb)
            if not len(own):
                continue
            distinct, back = np.unique(own, return_inverse=True)
            dw = np.bincount(back, err[of]) / n + decay * m.w[distinct]
            gw[distinct] += dw**2
            m.w[distinct] -= rate * dw / np.sqrt(gw[distinct])
            for k in range(RANK):
                sums = np.bincount(of, m.v[own, k], n)
                dv = np.bincount(back, err[of] * (sums[of] - m.v[own, k])) / n + 5 * decay * m.v[distinct, k]
                gv[distinct, k] += dv**2
                m.v[distinct, k] -= 0.1 * rate * dv / np.sqrt(gv[distinct, k])
    return m


def _term_rows(batches):
    """(toxic, term) for every distinct term of each text."""
    for part in slices(batches, "text"):
        data, offsets = text_buffers(part.column("text"))
        term, text = terms(data, offsets)
        yield pa.RecordBatch.from_arrays([part.column("toxic").take(pa.array(text)), pa.array(term.astype(np.int64))], ["toxic", "term"])


def _fit_rows(batches, names: np.ndarray):
    """Each text's label and those of its terms that are in names, as bytes."""
    own = Machine(0.0, names, np.zeros(0), np.zeros((0, 0)))
    wanted = own.wanted()
    for part in slices(batches, "text"):
        data, offsets = text_buffers(part.column("text"))
        term, text = own.own(*terms(data, offsets, wanted))
        bounds = np.searchsorted(text, np.arange(part.num_rows + 1))
        yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array([names[term[a:b]].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())], ["toxic", "terms"])


def telling_terms(rows: DataFrame, most: int = MOST_TERMS) -> np.ndarray:
    """The terms of labelled rows (toxic, text) that tell the classes apart, ascending: counted in Spark, and the `most` clearest at most."""
    n = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("n1"), F.count(F.lit(1)).alias("n")).first()
    n1, n0 = n["n1"], n["n"] - n["n1"]
    if not n1 or not n0:
        return np.zeros(0, np.uint32)
    counts = rows.mapInArrow(_term_rows, "toxic int, term long").groupBy("term").agg(F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("both"))
    p = F.col("both") / (n1 + n0)
    z = F.abs(F.col("a") / n1 - (F.col("both") - F.col("a")) / n0) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-12)) * (1 / n1 + 1 / n0))
    found = counts.select("term", "both", z.alias("z")).where((F.col("both") >= LEAST_TEXTS) & (F.col("z") >= LEAST_Z)).orderBy(F.desc("z"), "term").limit(most)
    return np.sort(np.array([r["term"] for r in found.select("term").collect()], np.int64)).astype(np.uint32)


def held_out(column: str = "doc_id"):
    return (F.crc32(F.col(column).cast("string").cast("binary")) % 3) == 1


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Machine:
    """Fit on labelled documents that are not held out: at most fit_rows of each class, those with the smallest hash of doc_id.

    Labels other than 0 and 1, null ids and null texts teach nothing. Without
    any usable label the machine answers 0.5 throughout.
    """
    ship(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long").alias("l_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1) and l_id is not null").where(~held_out("l_id")).distinct()
    picked = smallest(known.where("toxic = 1"), F.xxhash64("l_id"), fit_rows).unionByName(smallest(known.where("toxic = 0"), F.xxhash64("l_id"), fit_rows))
    # a bounded number of ids, so the side that is sent to every task is bounded as well
    rows = docs.select(F.col("doc_id").cast("long"), "text").where("text is not null").join(F.broadcast(picked), F.col("doc_id") == F.col("l_id")).select("toxic", "text")
    names = telling_terms(rows)
    got = rows.mapInArrow(lambda it: _fit_rows(it, names), "toxic int, terms binary").toArrow()
    each = sorted(zip(got.column("toxic").to_pylist(), got.column("terms").to_pylist(), strict=True))
    return fit([np.frombuffer(t, np.uint32) for _, t in each], np.array([k for k, _ in each], float), names)


def _score(batches, model, threshold: float):
    m = model.value
    wanted = m.wanted()
    for part in slices(batches, "text"):
        data, offsets = text_buffers(part.column("text"))
        score = m.score(*m.own(*terms(data, offsets, wanted)), part.num_rows)
        rest = [(n, part.column(n)) for n in part.schema.names]
        yield pa.RecordBatch.from_arrays([c for _, c in rest] + [pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32), pa.int32())], [n for n, _ in rest] + ["tox_score", "tox_predicted"])


def score_toxicity(docs: DataFrame, model: Machine, threshold: float = 0.7) -> DataFrame:
    """docs with tox_score (0 to 1) and tox_predicted (1 from `threshold` on). Needs a column text; null or empty text gets the bias alone.

    Rows are scored one by one, whatever else they hold; columns named
    tox_score or tox_predicted are replaced.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.drop("tox_score", "tox_predicted")
    sent = spark.sparkContext.broadcast(model)  # a few thousand terms at most, whatever the corpus
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + ["tox_score double", "tox_predicted int"])
    return docs.mapInArrow(lambda it: _score(it, sent, threshold), schema)
