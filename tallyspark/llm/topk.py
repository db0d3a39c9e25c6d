"""Exact top-k inner products by multi-resolution segment statistics.

Vectors are scaled to integers, floor(256 x). Cut into segments, a vector is
known by each segment's mean and deviation; by Cauchy and Schwarz

    |q - x|^2 >= sum over segments of length * ((mean_q - mean_x)^2 + (dev_q - dev_x)^2)

and since q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2, a lower bound of the distance
is an upper bound of the score. Resolutions go from one segment to many;
each drops the candidates whose bound is below the query's k-th best score so
far, and the scores of those left are computed exactly in integers.

Queries go out in blocks of at most QUERY_BLOCK vectors, each broadcast
alone (its size is bounded by that count and the dimension), against all
rows; a task keeps k rows per query, and a last aggregate joins the tasks'
rows. No pair is ever shuffled. The bounds never cut a true result, with a
margin for rounding.

Defined results: vectors that are null or hold a null or non-finite
component take no part, neither do rows without a vec_id; of repeated queries
with one vec_id and vector one is answered, and candidates with the query's
vec_id are left out; ties go to the smaller vec_id; vectors meet only those of
their own length (empty ones score 0 with each other); repeated candidate rows each take a place; a score beyond
the range of a long is its limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import store

K = 5
EVERY = 50
SCALE = 256
#: Query vectors per broadcast block, and candidate rows per step of a task.
QUERY_BLOCK = 4_096
ROWS = 2_048
QUERY_STEP = 512
#: Segments of the resolutions, coarse to fine.
SEGMENTS = (1, 4, 16)
#: Vectors whose products may sum to more are multiplied as Python integers.
_SAFE = 1 << 62


_LIMIT = (1 << 63) - 1


def _segments(x: np.ndarray, parts: int) -> list[np.ndarray]:
    return np.array_split(x, min(parts, x.shape[1]), axis=1)


def summary(x: np.ndarray, parts: int) -> np.ndarray:
    """Per row the segments' means and deviations, each times the root of the segment's length."""
    if not x.shape[1]:
        return np.zeros((len(x), 2))
    cut = _segments(x, parts)
    root = np.sqrt([c.shape[1] for c in cut])
    return np.concatenate([np.stack([c.mean(axis=1) for c in cut], axis=1) * root,
                           np.stack([c.std(axis=1) for c in cut], axis=1) * root], axis=1)


def _bound(q: np.ndarray, x: np.ndarray, q2: np.ndarray, x2: np.ndarray) -> np.ndarray:
    """Upper bounds of the inner products from the lower bounds of the distances."""
    low = (q * q).sum(axis=1)[:, None] + (x * x).sum(axis=1)[None, :] - 2 * (q @ x.T)
    return (q2[:, None] + x2[None, :] - np.maximum(low, 0)) / 2


class Block:
    """Integer query vectors of one length, their summaries, and the best scores met so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.v, self.k = ids, vectors, k
        self.f = vectors.astype(np.float64)
        self.norm = (self.f * self.f).sum(axis=1)
        self.summaries = [summary(self.f, s) for s in SEGMENTS]
        self.best = [[] for _ in ids]  # per query up to k (-score, vec_id)

    def take(self, ids: np.ndarray, x: np.ndarray) -> None:
        f = x.astype(np.float64)
        norm = (f * f).sum(axis=1)
        summaries = [summary(f, s) for s in SEGMENTS]
        safe = int(np.abs(x).max(initial=0)) * int(np.abs(self.v).max(initial=0)) * x.shape[1] < _SAFE
        for lo in range(0, len(self.ids), QUERY_STEP):
            hi = min(lo + QUERY_STEP, len(self.ids))
            floor = np.array([-b[-1][0] if len(b) == self.k else -np.inf for b in self.best[lo:hi]], dtype=np.float64)
            open_ = self.ids[lo:hi, None] != ids[None, :]
            margin = 1e-9 * (self.norm[lo:hi, None] + norm[None, :]) + 1e-6
            for q, s in zip(self.summaries, summaries, strict=True):
                open_ &= _bound(q[lo:hi], s, self.norm[lo:hi], norm) + margin >= floor[:, None]
            for i in np.flatnonzero(open_.any(axis=1)):
                at = np.flatnonzero(open_[i])
                q = self.v[lo + i]
                if safe:
                    score = x[at] @ q
                    if len(at) > 4 * self.k:
                        cut = np.partition(score, len(at) - self.k)[len(at) - self.k]
                        at, score = at[score >= cut], score[score >= cut]
                    score = score.tolist()
                else:
                    score = [max(-_LIMIT, min(_LIMIT, sum(int(a) * int(b) for a, b in zip(row, q, strict=True)))) for row in x[at]]
                self.best[lo + i] = sorted(self.best[lo + i] + [(-s, v) for s, v in zip(score, ids[at].tolist(), strict=True)])[:self.k]


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): the usable rows, scaled."""
    x = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e")).filter(
        "vec_id IS NOT NULL AND e IS NOT NULL")
    usable = ~F.exists("e", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return x.filter(F.coalesce(usable, F.lit(False))).select("vec_id", F.transform("e", lambda c: F.floor(c * SCALE)).alias("v"))


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    ids, column = batch.column(0).to_numpy(), batch.column(1)
    size = np.diff(column.offsets.to_numpy())
    flat = column.values.to_numpy(zero_copy_only=False)
    start = column.offsets.to_numpy()[:-1]
    for n in np.unique(size):
        rows = np.flatnonzero(size == n)
        yield ids[rows], flat[start[rows][:, None] + np.arange(n)]


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest inner products of each
    query, a row whose vec_id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = store(integers(vectors), "op5-vectors")
    queries = rows.filter(F.pmod("vec_id", F.lit(every)) == 0).distinct()
    count = queries.count()
    blocks = max(1, -(-count // QUERY_BLOCK))
    queries = store(queries.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks))), "op5-queries")
    found = None
    for b in range(blocks):
        mine = queries.filter(F.col("block") == b).select("vec_id", "v").orderBy("vec_id", "v").collect()
        by_length: dict[int, list] = {}
        for r in mine:
            by_length.setdefault(len(r["v"]), []).append(r)
        told = spark.sparkContext.broadcast({n: (np.array([r["vec_id"] for r in g], dtype=np.int64), np.array([r["v"] for r in g], dtype=np.int64))
                                             for n, g in by_length.items()})

        def run(batches: Iterator[pa.RecordBatch], told=told) -> Iterator[pa.RecordBatch]:
            held = {n: Block(i, v, k) for n, (i, v) in told.value.items()}
            for batch in batches:
                for ids, x in _by_length(batch):
                    if x.shape[1] in held:
                        for lo in range(0, len(ids), ROWS):
                            held[x.shape[1]].take(ids[lo:lo + ROWS], x[lo:lo + ROWS])
            out = [(int(q), n, i, v, -s) for n, h in held.items() for i, (q, best) in enumerate(zip(h.ids, h.best, strict=True)) for s, v in best]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], pa.int64()) for j in range(5)],
                                             ["query_id", "length", "place", "vec_id", "score"])

        part = rows.mapInArrow(run, "query_id long, length long, place long, vec_id long, score long").withColumn("block", F.lit(b))
        found = part if found is None else found.union(part)
    # Each task has k rows a query at most; joined by a bounded list per query.
    best = found.groupBy("block", "length", "place", "query_id").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), "vec_id"))), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("rank", "b")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), "b.vec_id", (-F.col("b.down")).alias("score"))
