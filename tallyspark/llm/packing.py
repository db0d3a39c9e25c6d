"""Best-fit packing of tokenized documents into sequences, large items matched first.

1. Every document is tokenized whole and ends with the separator id 0; only
   a document longer than the capacity is cut, into full pieces and a rest.
   Pieces are stored with their rank among the pieces of equal length of
   their task.
2. The plan is made on the histogram of lengths, which has no more entries
   than the capacity has tokens, whatever the corpus: pieces of over a third
   of the capacity share a bin with one other such piece at most and are
   matched greedily, largest first with the largest that still fits; smaller
   pieces, longest first, go to the fullest bins that hold them (best fit),
   and new bins open only when none does. Equal steps are taken for whole
   ranges of bins at once.
3. A piece finds its step by its length and its rank among all pieces of
   that length: the tasks' counts per length are summed up over the tasks,
   so no length gathers in one task, however many copies it has.

Defined results: a null or empty text is one piece of one id (0); repeated
rows are packed each for itself; doc_id may be null; extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import os
import sys
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import store

CAPACITY = 2048
SEPARATOR = 0
#: Encoded words that a worker remembers before it starts anew.
CACHE_WORDS = 250_000


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies write bytes: printable Latin-1
    characters stand for themselves, the other bytes for those from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class WordIds(dict):
    """Little-endian unsigned 32-bit ids of a blank-separated word, encoded when first met.

    The tokenizer drops white space and never joins across it, so a text's
    ids are those of its words in order. A word of Latin-1 letters, also with
    one stop or comma behind it, is a single piece (two with the mark) to
    the tokenizer's splitter and goes to its BPE model directly; any other
    word goes through the whole tokenizer.
    """

    _by_path: dict[str, WordIds] = {}
    _letters = _byte_letters()

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model

    @classmethod
    def at(cls, path: str | None) -> WordIds:
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path("word_bpe_49k.json")
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    def __missing__(self, word: str) -> bytes:
        if not word:
            return b""
        body, mark = (word[:-1], word[-1]) if word[-1] in ".," and len(word) > 1 else (word, "")
        low = body.lower()
        if low.isalpha() and (low.isascii() or max(low) <= "\u00ff"):
            if mark or low != word:
                ids = self[low] + (self[mark] if mark else b"")
            else:
                piece = low if low.isascii() else low.encode().decode("latin-1").translate(self._letters)
                ids = array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()
        else:
            ids = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def text(self, text: str) -> bytes:
        """Ids of a whole text, the separator at the end."""
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.__getitem__, words)) + _END


if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("ids are kept as little-endian 32-bit numbers")
_END = array("I", [SEPARATOR]).tobytes()


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer_path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, rank[, ids])."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordIds.at(tokenizer_path)
        task = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        step = 4 * capacity
        for batch in batches:
            of, piece, start, length, crc, rank, kept = [], [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = encoder.text(text.as_py() or "")
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    n = len(part) // 4
                    of.append(row)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    rank.append(seen[n])
                    seen[n] += 1
                    if keep_ids:
                        kept.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
            cols = [batch.column(0).take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(np.full(len(of), task), pa.int64()),
                    pa.array(rank, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"]
            if keep_ids:
                cols.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, rank long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, schema + (", ids array<int>" if keep_ids else ""))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Steps (length, first rank, count, first bin, offset): the pieces of that
    length from that rank on go, one each, to so many consecutive bins."""
    left = {n: c for n, c in counts.items() if c}
    used = dict.fromkeys(left, 0)
    steps: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []
    bins = 0

    def put(n: int, count: int, first: int, offset: int) -> None:
        steps.append((n, used[n], count, first, offset))
        used[n] += count
        left[n] -= count

    def leave(gap: int, first: int, count: int) -> None:
        if gap not in gaps:
            gaps[gap] = []
            insort(order, gap)
        gaps[gap].append((first, count))

    large = sorted(n for n in left if 3 * n > capacity)
    for n in reversed(large):
        while left[n]:
            k = bisect_left(large, capacity - n + 1) - 1
            while k >= 0 and left[large[k]] < (2 if large[k] == n else 1):
                k -= 1
            mate = large[k] if k >= 0 else None
            count = left[n] if mate is None else left[n] // 2 if mate == n else min(left[n], left[mate])
            put(n, count, bins, 0)
            if mate is not None:
                put(mate, count, bins, n)
            leave(capacity - n - (mate or 0), bins, count)
            bins += count
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            k = bisect_left(order, n)
            if k == len(order):
                count = -(-left[n] // (capacity // n))
                leave(capacity, bins, count)
                bins += count
                continue
            gap = order[k]
            first, room = gaps[gap].pop()
            count = min(room, left[n])
            if room > count:
                gaps[gap].append((first + count, room - count))
            elif not gaps[gap]:
                del gaps[gap], order[k]
            put(n, count, first, capacity - gap)
            if gap > n:
                leave(gap - n, first, count)
    return np.array(sorted(steps), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer_path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) for every piece of every document."""
    spark = docs.sparkSession
    made = store(pieces(docs, capacity, tokenizer_path, keep_ids), "op10-pieces")
    per_task = store(made.groupBy("task", "length").count(), "op10-counts")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    steps = plan(counts, capacity)
    told = spark.sparkContext.broadcast(steps)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("task", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    ranked = made.join(offsets, ["task", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "rank"] + ["ids"] * keep_ids

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = told.value
        key = (s[:, 0] << 48) + s[:, 1]
        for batch in batches:
            n, r = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = np.searchsorted(key, (n << 48) + r, side="right") - 1
            cols = [batch.column(i) for i in range(5)] + [pa.array(s[at, 3] + r - s[at, 1]), pa.array(s[at, 4])]
            yield pa.RecordBatch.from_arrays(cols + batch.columns[6:], names[:5] + ["sequence_id", "offset"] + names[6:])

    return ranked.select(*names).mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
        + (", ids array<int>" if keep_ids else ""))
