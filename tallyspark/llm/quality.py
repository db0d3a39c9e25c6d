"""Quality classifier: ordinal cumulative-link regression on graded ratings.

The rating of a labelled document has three grades: 0 (``quality`` 0),
1 (``quality`` 1, ``toxic`` 1) and 2 (``quality`` 1, not toxic). One weight
vector over hashed text features gives a score f, and ordered thresholds
t0 < t1 cut it: P(rating <= k) = logistic(t_k - f). The expected grade and
the tail probabilities P(rating >= k) follow; a document is selected when
P(rating >= 1) >= SELECT_AT.

Features, all hashed into BUCKETS weights: the share of each word (letters,
digits, non-ASCII bytes, lower-cased) and of each pattern (case, and the
signs around the word) among the words of a text, and one indicator each
for the binned share of words that repeat the word before them and of words
that are a sign only.

The model is fitted on the driver on at most SAMPLE_ROWS labelled documents
(their features, not their texts), chosen by a hash of doc_id; every
document of the table is scored whole, in one pass without a shuffle.

Defined results: a null or empty text has only its indicators; a null
label counts as missing (the row is not used; a null ``toxic`` is 0); of
repeated labels each is used; without labels, or with one grade only, the
thresholds follow smoothed counts. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import ASCII_LOWER, BLANK_CUT, mix64, text_chunks, word_hashes, word_spans

BUCKETS = 1 << 16
GRADES = 3
#: Labelled documents that the model is fitted on, at most.
SAMPLE_ROWS = 8_000
SELECT_AT = 0.5
#: Weight of a word's share; strength of the ridge penalty; steps of the fit.
SHARE_SCALE, RIDGE, STEPS = 8.0, 2e-4, 250
_SEED_WORD, _SEED_PATTERN, _SEED_FLAG = np.uint64(11), np.uint64(12), np.uint64(13)

_CORE = np.zeros(256, dtype=bool)
_CORE[48:58] = _CORE[65:91] = _CORE[97:123] = _CORE[128:] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
#: For patterns: letters become a, capitals A, digits 0; signs stay.
_PATTERN = np.arange(256, dtype=np.uint8)
_PATTERN[65:91], _PATTERN[97:123], _PATTERN[48:58], _PATTERN[128:] = 65, 97, 48, 97


def _bucket(h: np.ndarray, seed: np.uint64) -> np.ndarray:
    return (mix64(h ^ mix64(np.array([seed], dtype=np.uint64))) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _running(hit: np.ndarray) -> np.ndarray:
    """Sums of the hits before each byte, and of all: as narrow as a chunk of texts allows, since there is one per byte."""
    out = np.zeros(len(hit) + 1, dtype=np.int32 if len(hit) < 1 << 31 else np.int64)
    np.cumsum(hit, out=out[1:], dtype=out.dtype)
    return out


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By chunks of texts: (bucket, value) of every feature occurrence, in text
    order, and the index of each text's first one."""
    for _, raw, offsets in text_chunks(column):
        starts, ends, first = word_spans(raw, offsets, BLANK_CUT)
        n = len(starts)
        per = np.diff(first)
        text = np.repeat(np.arange(len(per)), per)
        core = _running(_CORE[raw])
        inner = core[ends] - core[starts]
        del core
        words = word_hashes(ASCII_LOWER[raw], starts, ends)
        # The pattern of a word: its first two and last three bytes as kinds, and whether it is all capitals.
        kind = _PATTERN[raw]
        last = np.maximum(ends - 1, 0)
        capitals = _running(_UPPER[raw])
        pattern = np.zeros(n, dtype=np.uint64)
        for place in (starts, np.minimum(starts + 1, last), np.maximum(last - 2, starts), np.maximum(last - 1, starts), last):
            pattern = pattern * np.uint64(257) + (kind[place].astype(np.uint64) if n else pattern)
        pattern = pattern * np.uint64(2) + (capitals[ends] - capitals[starts] >= np.maximum(2, inner)).astype(np.uint64)
        del kind, capitals
        share = SHARE_SCALE / np.maximum(per, 1)[text]
        again = np.r_[False, words[1:] == words[:-1]] if n else np.zeros(0, bool)
        again[first[:-1][per > 0]] = False
        flags = []
        for k, hit in enumerate((again, inner == 0)):
            part = np.bincount(text, weights=hit, minlength=len(per)) / np.maximum(per, 1)
            level = np.ceil(np.minimum(part, 0.5) * 10).astype(np.uint64)
            flags.append(_bucket(np.uint64(100 * k) + level, _SEED_FLAG))
        bucket = np.empty(2 * n + 2 * len(per), dtype=np.int64)
        value = np.empty(len(bucket))
        begin = 2 * first[:-1] + 2 * np.arange(len(per))
        at = 2 * np.arange(n) + 2 * text
        bucket[at], bucket[at + 1] = _bucket(words, _SEED_WORD), _bucket(pattern, _SEED_PATTERN)
        value[at], value[at + 1] = share, share
        end = begin + 2 * per
        for k in (0, 1):
            bucket[end + k], value[end + k] = flags[k], 1.0
        yield bucket, value, np.r_[begin, len(bucket)]


def _sums(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the ranges [first[i], first[i + 1]); every range holds something."""
    return np.add.reduceat(value, first[:-1]) if len(first) > 1 else np.zeros(0)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, f: np.ndarray) -> np.ndarray:
        """P(rating >= k) for k from 1, one column each."""
        return 1 - _logistic(self.thresholds[None, :] - f[:, None])

    def scores(self, column: pa.Array) -> np.ndarray:
        parts = [_sums(self.weights[b] * v, first) for b, v, first in features(column)]
        return np.concatenate(parts) if parts else np.zeros(0)


def fit(bucket: np.ndarray, value: np.ndarray, row: np.ndarray, grade: np.ndarray, grades: int = GRADES) -> OrdinalModel:
    """Maximum likelihood with a ridge penalty, by Adam over all rows at once."""
    n = len(grade)
    count = np.bincount(grade, minlength=grades) + 1.0
    low = np.cumsum(count)[:-1] / count.sum()
    first = np.log(low / (1 - low))
    theta = np.r_[first[0], np.log(np.maximum(np.diff(first), 1e-3))]  # the first threshold, then logarithms of the steps
    used, b = np.unique(bucket, return_inverse=True)
    b = b.astype(np.int32)
    w = np.zeros(len(used))
    m, v = np.zeros(len(w) + len(theta)), np.zeros(len(w) + len(theta))
    index = np.arange(n)
    for t in range(1, STEPS + 1) if n else ():
        cut = np.cumsum(np.r_[theta[0], np.exp(theta[1:])])
        f = np.bincount(row, weights=w[b] * value, minlength=n)
        below = np.c_[np.zeros(n), _logistic(cut[None, :] - f[:, None]), np.ones(n)]
        hi, lo = below[index, grade + 1], below[index, grade]
        p = np.maximum(hi - lo, 1e-12)
        g_f = 1 - hi - lo  # of the negative log-likelihood
        slope = below[:, 1:-1] * (1 - below[:, 1:-1])
        g_cut = np.array([((grade == k + 1) * slope[:, k] / p - (grade == k) * slope[:, k] / p).sum() for k in range(grades - 1)])
        g_theta = np.r_[g_cut.sum(), [np.exp(theta[j]) * g_cut[j:].sum() for j in range(1, grades - 1)]]
        g = np.r_[np.bincount(b, weights=g_f[row] * value, minlength=len(w)) / n + RIDGE * w, g_theta / n]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
        w, theta = w - step[:len(w)], theta - step[len(w):]
    weights = np.zeros(BUCKETS)
    weights[used] = w
    return OrdinalModel(weights, np.cumsum(np.r_[theta[0], np.exp(theta[1:])]))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """Fit on a bounded sample of the labelled documents."""
    graded = (labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL")
              .select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.expr("CASE WHEN quality < 1 THEN 0 WHEN coalesce(toxic, 0) > 0 THEN 1 ELSE 2 END").alias("grade"))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for bucket, value, first in features(batch.column(2)):
                for lo, hi in zip(first[:-1], first[1:], strict=True):
                    b, inverse = np.unique(bucket[lo:hi], return_inverse=True)
                    rows.append((b.astype("<i4").tobytes(), np.bincount(inverse, weights=value[lo:hi]).astype("<f4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array([r[j] for r in rows], pa.binary()) for j in (0, 1))],
                ["doc_id", "grade", "bucket", "value"])

    # At most SAMPLE_ROWS labels: small enough to send to every task.
    found = (texts.join(F.broadcast(graded), "doc_id").select("doc_id", "grade", "text")
             .mapInArrow(run, "doc_id long, grade int, bucket binary, value binary"))
    # Packed, some 5 kB a document; taken partition by partition.
    rows = sorted((r["doc_id"], r["grade"], bytes(r["bucket"]), bytes(r["value"])) for r in found.toLocalIterator())
    if not rows:
        return fit(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))
    size = [len(r[2]) // 4 for r in rows]
    bucket, value = (np.frombuffer(b"".join(r[j] for r in rows), dtype=t) for j, t in ((2, "<i4"), (3, "<f4")))
    grade = np.array([r[1] for r in rows])
    del rows
    return fit(bucket, value, np.repeat(np.arange(len(size), dtype=np.int32), size), grade)


def score(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """(doc_id, expected_grade, p_at_least_1, p_at_least_2, selected) for every row."""
    told = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = told.value.tails(told.value.scores(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p.sum(axis=1)), pa.array(p[:, 0]), pa.array(p[:, 1]), pa.array(p[:, 0] >= SELECT_AT)],
                ["doc_id", "expected_grade", "p_at_least_1", "p_at_least_2", "selected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, expected_grade double, p_at_least_1 double, p_at_least_2 double, selected boolean")


def select_good(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """The selected rows of ``docs`` with all their columns."""
    told = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = told.value.tails(told.value.scores(batch.column(1)))[:, 0] >= SELECT_AT
            rows = batch.column(0).filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays(rows.flatten(), [f.name for f in rows.type])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, docs.schema)
