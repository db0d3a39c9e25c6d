"""Benchmark decontamination: SimHash windows, multi-index Hamming blocks, exact check.

Words are lower-cased runs of letters, digits and other non-ASCII bytes.
Items are grouped into size classes. In a class whose items have at least
``m`` words, windows hold ``m / 2`` words, and items and documents have the
fingerprints of all their windows, one starting at every word: an edited
passage is found by any stretch of half an item that its edits leave alike. A fingerprint is the 64-bit
weighted SimHash of the window's words (rare words count more).

A document has fingerprints only around five-word shingles that an item
holds too: an item-sized window without any has similarity 0. The shingles of
a text are looked up in the sorted shingles of all items, and only windows
from which a hit can be reached are fingerprinted, which changes no result.

Fingerprints are compared through four 16-bit blocks: the tables of a class
list, for every value of a block, the item windows within one bit of it. By
the pigeonhole principle every pair within RADIUS = 4 * (1 + 1) - 1 = 7 bits
agrees so in one block, so none is missed. What is found is verified
exactly: the document window of the item's full size at the implied place
(and up to SHIFT words beside it; cut at the end of the text, where the last
whole window is tried too) must have a weighted Jaccard similarity of
0.75 or more with the item over distinct five-word shingles, weighted by
log(1 + items / items with the shingle), counted over the whole benchmark for
the item's and the window's shingles alike (one that no item holds weighs log(1 + items)).

Items go to the tasks in blocks of at most ITEM_BLOCK items and
ITEM_BLOCK_WORDS words; a larger benchmark takes several passes. Each has the
whole benchmark's counts, so the blocks change no result. Documents
are never shuffled, and a long one is worked through in blocks of words.

Defined results: null or empty texts and items match nothing; repeated rows
are reported each; of equal similarities the first window counts; items of
fewer than five words can't be told from ordinary text and match nothing; a null item_id or
doc_id is reported as null.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import _SHINGLE_MULT, mix64, text_chunks, word_hashes, word_spans

SIMILARITY = 0.75
SHINGLE = 5
#: Windows are found when their fingerprints differ in at most so many bits.
RADIUS = 7
#: Words beside the implied place where an item-sized window is tried too.
SHIFT = 2
ITEM_BLOCK = 5_000
ITEM_BLOCK_WORDS = 500_000
#: Size classes grow by this ratio.
CLASS_RATIO = 4 / 3
#: Words of one vectorised step, and of a window at most (its weights fit 16 bits).
STEP_WORDS = 1 << 15
MAX_WINDOW = 20_000
_COMMON_SHARE, _RARE_WEIGHT = 0.02, 3
_SIEVE_BITS = 24

_WORD_BYTES = np.zeros(256, dtype=bool)
_WORD_BYTES[48:58] = _WORD_BYTES[65:91] = _WORD_BYTES[97:123] = _WORD_BYTES[128:] = True


def _words(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, index of each text's first word) by chunks of texts."""
    for row, raw, offsets in text_chunks(column):
        starts, ends, first = word_spans(raw, offsets, _WORD_BYTES)
        yield row, word_hashes(raw, starts, ends), first


def _shingles(w: np.ndarray) -> np.ndarray:
    """Distinct shingle hashes of a word sequence."""
    k = min(SHINGLE, len(w))
    if not k:
        return w[:0]
    g = np.full(len(w) - k + 1, k, dtype=np.uint64)
    for j in range(k):
        g += w[j:len(w) - k + 1 + j] * _SHINGLE_MULT[j]
    return np.unique(mix64(g))


#: For a byte, its bits as eight 16-bit counters in two 64-bit numbers.
_COUNTERS = np.array([[sum(((v >> (4 * h + i)) & 1) << (16 * i) for i in range(4)) for v in range(256)] for h in range(2)], dtype=np.uint64)


def _running(w: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Running sums, word by word, of the 64 bits' weights (rows 0 to 15, four counters each) and of
    the weights (row 16). Counters may carry over; differences of less than 2**16 are exact all the same."""
    out = np.zeros((17, len(w) + 1), dtype=np.uint64)
    octets = w.astype("<u8").view(np.uint8).reshape(-1, 8)
    for j in range(8):
        column = np.ascontiguousarray(octets[:, j])
        for h in range(2):
            np.cumsum(_COUNTERS[h][column] * weight, out=out[2 * j + h, 1:])
    np.cumsum(weight, out=out[16, 1:])
    return out


def _fingerprints(running: np.ndarray, size: int) -> np.ndarray:
    """SimHash of every window of ``size`` words, by its first word."""
    sums = running[:, size:] - running[:, :running.shape[1] - size]
    ones = np.ascontiguousarray(sums[:16].T).view("<u2")
    return np.packbits(ones > (sums[16] >> np.uint64(1)).astype(np.uint16)[:, None], axis=1).view("<u8").ravel()


def _item_words(texts: pa.Array) -> list[np.ndarray]:
    return [w[first[i]:first[i + 1]] for _, w, first in _words(texts) for i in range(len(first) - 1)]


def _size_class(n: int) -> int:
    return int(math.log(n, CLASS_RATIO) + 1e-9)


def _window(size_class: int) -> int:
    """Half the fewest words of a class, whichever of its items a block has."""
    shortest = max(SHINGLE, math.ceil(CLASS_RATIO ** size_class - 1e-6))
    return min(shortest // 2, MAX_WINDOW)


class Counts:
    """Over the whole benchmark: its items, how many hold each shingle that two or more hold, and its common words."""

    def __init__(self, n: int, shingles: dict[int, int], common: list[int]):
        self.n = max(1, n)
        self.shingles = np.array(sorted(shingles), dtype=np.uint64)
        self.holders = np.array([shingles[g] for g in sorted(shingles)], dtype=np.int64)
        self.common = np.sort(np.array(common, dtype=np.uint64))

    def weights(self, g: np.ndarray) -> np.ndarray:
        """log(1 + items / items with the shingle); a shingle that no item holds weighs like one that a single item holds."""
        holders = np.ones(len(g), dtype=np.int64)
        if len(self.shingles):
            at = np.minimum(np.searchsorted(self.shingles, g), len(self.shingles) - 1)
            holders = np.where(self.shingles[at] == g, self.holders[at], 1)
        return np.log(1 + self.n / holders)


def _least_common(n: int) -> float:
    return max(2, _COMMON_SHARE * n)


def count(rows: DataFrame) -> Counts:
    """The counts over all items, in one aggregate; what reaches the driver is one row per shared shingle and common word."""
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in _item_words(batch.column(0)):
                both = np.concatenate([_shingles(w), np.unique(w)])
                kind = np.arange(len(both)) >= len(both) - len(np.unique(w))
                yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(both.view(np.int64))], ["word", "hash"])

    n = rows.count()
    held = rows.select("text").mapInArrow(hashes, "word boolean, hash long").groupBy("word", "hash").count()
    found = held.filter(F.col("count") >= F.when(F.col("word"), F.lit(float(_least_common(n)))).otherwise(F.lit(2.0))).collect()
    code = lambda r: r["hash"] % (1 << 64)
    return Counts(n, {code(r): r["count"] for r in found if not r["word"]}, [code(r) for r in found if r["word"]])


class Items:
    """The benchmark items of a block, as the tasks use them; ``counts`` are those of the whole benchmark, by default these items."""

    def __init__(self, rows: list[tuple[int | None, str]], counts: Counts | None = None):
        rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        self.words = _item_words(pa.array([t for _, t in rows], pa.string()))
        self.ids = [i for i, _ in rows]
        self.sets = [_shingles(w) for w in self.words]
        if counts is None:
            seen = Counter(g for s in self.sets for g in s.tolist())
            words_in = Counter(g for w in self.words for g in set(w.tolist()))
            counts = Counts(len(rows), {g: c for g, c in seen.items() if c > 1}, [g for g, c in words_in.items() if c >= _least_common(len(rows))])
        self.counts, self.common = counts, counts.common
        self.weights = [counts.weights(s) for s in self.sets]
        by_class: dict[int, list[int]] = {}
        for i, w in enumerate(self.words):
            if len(w) >= SHINGLE:
                by_class.setdefault(_size_class(len(w)), []).append(i)
        self.classes = [self._tables(members) for members in by_class.values()]
        self.longest = max((c["size"] for c in self.classes), default=0)
        self.known = np.unique(np.concatenate([self.sets[i] for m in by_class.values() for i in m])) if by_class else np.zeros(0, np.uint64)
        self._sieve = None

    def holds(self, g: np.ndarray) -> np.ndarray:
        """Whether any item has the shingle: a sieve over its first bits (made in the task), then the sorted shingles."""
        if not len(self.known):
            return np.zeros(len(g), dtype=bool)
        if self._sieve is None:
            self._sieve = np.zeros(1 << _SIEVE_BITS, dtype=bool)
            self._sieve[self.known >> np.uint64(64 - _SIEVE_BITS)] = True
        out = self._sieve[g >> np.uint64(64 - _SIEVE_BITS)]
        may = np.flatnonzero(out)
        at = np.minimum(np.searchsorted(self.known, g[may]), len(self.known) - 1)
        out[may] = self.known[at] == g[may]
        return out

    def weight(self, w: np.ndarray) -> np.ndarray:
        if not len(self.common):
            return np.full(len(w), _RARE_WEIGHT, dtype=np.uint64)
        at = np.minimum(np.searchsorted(self.common, w), len(self.common) - 1)
        return np.where(self.common[at] == w, 1, _RARE_WEIGHT).astype(np.uint64)

    def _tables(self, members: list[int]) -> dict:
        size = _window(_size_class(len(self.words[members[0]])))
        prints, item, offset = [], [], []
        for i in members:
            w = self.words[i]
            at = np.arange(len(w) - size + 1)
            prints.append(_fingerprints(_running(w, self.weight(w)), size))
            item.append(np.full(len(at), i))
            offset.append(at)
        prints = np.concatenate(prints)
        near = np.r_[0, 1 << np.arange(16)].astype(np.int64)
        blocks = []
        for b in range(4):
            value = ((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
            key = (value[:, None] ^ near[None, :]).ravel()
            order = np.argsort(key, kind="stable")
            blocks.append((np.searchsorted(key[order], np.arange(65537)), order // len(near)))
        # An implied place is up to an item before the window, the windows verified there reach up to an item beyond it.
        reach = 2 * max(len(self.words[i]) for i in members) + SHIFT + SHINGLE
        return {"size": size, "reach": reach, "prints": prints, "blocks": blocks,
                "item": np.concatenate(item), "offset": np.concatenate(offset)}


def _near(prints: np.ndarray, tables: dict) -> tuple[np.ndarray, np.ndarray]:
    """(window, item window) pairs within RADIUS bits."""
    found = []
    for b, (start, ids) in enumerate(tables["blocks"]):
        value = ((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
        lo, count = start[value], start[value + 1] - start[value]
        window = np.repeat(np.arange(len(prints)), count)
        if not len(window):
            continue
        at = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
        other = ids[at]
        close = np.bitwise_count(prints[window] ^ tables["prints"][other]) <= RADIUS
        found.append(np.stack([window[close], other[close]]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.unique(np.concatenate(found, axis=1), axis=1)
    return pairs[0], pairs[1]


def _similarity(items: Items, i: int, w: np.ndarray) -> float:
    """Weighted Jaccard similarity of item i with a window's words."""
    mine, theirs = items.sets[i], _shingles(w)
    both = np.isin(mine, theirs, assume_unique=True)
    common = items.weights[i][both].sum()
    if not common:
        return 0.0
    others = theirs[~np.isin(theirs, mine, assume_unique=True)]
    return float(common / (items.weights[i].sum() + items.counts.weights(others).sum()))


def _starts(begin: int, end: int, n: int, place: int) -> list[int]:
    """Starts to verify around ``place`` in the text ``begin``..``end``. Windows are cut at the end of the
    text; where they may be, the last whole window (or whole text) is tried too."""
    low = max(begin, place - SHIFT)
    starts = set(range(low, max(low, min(place + SHIFT, end - 1)) + 1))
    if place + SHIFT > end - n:
        starts.add(max(begin, end - n))
    return sorted(starts)


def _hits(items: Items, w: np.ndarray) -> np.ndarray:
    """Where a shingle begins that an item holds (ascending)."""
    out = []
    for lo in range(0, len(w) - SHINGLE + 1, STEP_WORDS):
        part = w[lo:lo + STEP_WORDS + SHINGLE - 1]
        g = np.full(len(part) - SHINGLE + 1, SHINGLE, dtype=np.uint64)
        for j in range(SHINGLE):
            g += part[j:len(part) - SHINGLE + 1 + j] * _SHINGLE_MULT[j]
        out.append(lo + np.flatnonzero(items.holds(mix64(g))))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _around(hits: np.ndarray, reach: int, n: int) -> np.ndarray:
    """Which of ``n`` words are within ``reach`` of a hit."""
    step = np.bincount(np.maximum(hits - reach, 0), minlength=n + 1) - np.bincount(np.minimum(hits + reach + 1, n), minlength=n + 1)
    return np.cumsum(step)[:n] > 0


def matches(items: Items, column: pa.Array) -> list[tuple[int, int, float, int]]:
    """(row, item, similarity, first word) of the best window for each row and item that match."""
    best: dict[tuple[int, int], tuple[float, int]] = {}
    for row, w, first in _words(column):
        hits = _hits(items, w)
        if not len(hits):
            continue
        tried: set[tuple[int, int, int]] = set()
        near = [_around(hits, c["reach"] + c["size"], len(w)) for c in items.classes]
        # The words around hits, side by side; a window ends with its stretch or its text.
        kept = np.flatnonzero(np.logical_or.reduce(near))
        text = np.searchsorted(first, kept, side="right") - 1
        last = np.r_[np.flatnonzero((np.diff(kept) > 1) | (np.diff(text) > 0)), len(kept) - 1]
        left = last[np.searchsorted(last, np.arange(len(kept)))] - np.arange(len(kept)) + 1
        words = w[kept]
        for lo in range(0, len(kept), STEP_WORDS):
            part = words[lo:lo + STEP_WORDS + items.longest]
            running = _running(part, items.weight(part))
            here = slice(lo, lo + STEP_WORDS)
            for c, mine in zip(items.classes, near, strict=True):
                at = np.flatnonzero((left[here] >= c["size"]) & mine[kept[here]])
                if not len(at):
                    continue
                window, other = _near(_fingerprints(running[:, :at[-1] + c["size"] + 1], c["size"])[at], c)
                at = lo + at[window]
                for t, p, i in zip(text[at].tolist(), (kept[at] - c["offset"][other]).tolist(), c["item"][other].tolist(), strict=True):
                    tried.add((t, i, p))
        for t, i, p in sorted(tried):
            n, begin, end = len(items.words[i]), int(first[t]), int(first[t + 1])
            for s in _starts(begin, end, n, p):
                v = _similarity(items, i, w[s:min(s + n, end)])
                if v >= SIMILARITY and (v, begin - s) > best.get((row + t, i), (0.0, 0)):
                    best[row + t, i] = (v, begin - s)
    return [(t, i, v, -s) for (t, i), (v, s) in sorted(best.items())]


def item_blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The items, in blocks of bounded size; each is gathered on the driver alone."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                            F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))
    n, chars = rows.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // ITEM_BLOCK), -(-chars // (2 * ITEM_BLOCK_WORDS)))
    counts = count(rows)
    for b in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) if blocks > 1 else rows
        yield Items([(r["item_id"], r["text"]) for r in part.collect()], counts)


def _lowered(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.lower(F.col("text").cast("string")).alias("text"))


def find_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words) for every document and item that match."""
    spark = docs.sparkSession
    out = None
    for items in item_blocks(benchmark):
        told = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], told=told) -> Iterator[pa.RecordBatch]:
            items = told.value
            for batch in batches:
                found = matches(items, batch.column(1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([x[0] for x in found], pa.int64())),
                     pa.array([items.ids[x[1]] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.float64()),
                     pa.array([x[3] for x in found], pa.int64()), pa.array([len(items.words[x[1]]) for x in found], pa.int64())],
                    ["doc_id", "item_id", "similarity", "first_word", "n_words"])

        part = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text")).mapInArrow(
            run, "doc_id long, item_id long, similarity double, first_word long, n_words long")
        out = part if out is None else out.union(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    spark = docs.sparkSession
    schema = docs.schema
    for items in item_blocks(benchmark):
        told = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], told=told) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                clean[[x[0] for x in matches(told.value, batch.column(1))]] = False
                rows = batch.column(0).filter(pa.array(clean))
                yield pa.RecordBatch.from_arrays(rows.flatten(), [f.name for f in rows.type])

        docs = _lowered(docs).mapInArrow(run, schema)
    return docs
