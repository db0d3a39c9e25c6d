"""Helpers shared by the corpus operators: tables, storage, vectorised word hashes.

Word hashing works on the Arrow buffers of a whole batch of texts: numpy
reads the bytes of all words eight at a time, so no Python object is made
per word. Hashes are 64-bit, seeded by constants only, and therefore equal
in every worker.
"""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import ensure_checkpoint_dir

#: Rows of two numbers up to which a table is broadcast (8 MB); beyond, it is a shuffled join.
BROADCAST_ROWS = 1 << 19
#: Bytes of text that one vectorised step handles; a longer text is a step of its own.
CHUNK_BYTES = 2 << 20

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_LANE_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
#: Words longer than this are hashed one by one.
_LONG_WORD = 128


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per context. The archive lies in the shared checkpoint folder, so
    executors that start late or again find it. A local run whose search path or working folder has the package needs none."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    sc = spark.sparkContext
    here = sc.master.startswith("local") and any(os.path.realpath(p or ".") == os.path.realpath(root) for p in known)
    if here or not os.path.isdir(root) or sc.applicationId in _SHIPPED:
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(os.path.join(root, "tallyspark")):
            for name in sorted(n for n in names if n.endswith(".py")):
                file = os.path.join(folder, name)
                z.write(file, os.path.relpath(file, root))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/tallyspark-{uuid.uuid4().hex}.zip"
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(sc._jsc.hadoopConfiguration()).create(place)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


_SHIPPED: set[str] = set()


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new folder under the cluster's shared checkpoint
    folder and read it back: a lineage cut that outlives lost executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (multiply and xor-shift)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def text_chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield (first row, bytes, offsets) over a string column, in steps of
    about CHUNK_BYTES. A null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    big = pa.types.is_large_string(column.type)
    _, offs, data = column.buffers()
    n = len(column)
    if n == 0:
        return
    o = np.frombuffer(offs, dtype=np.int64 if big else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(o, o[i] + CHUNK_BYTES, side="right")) - 1)
        j = min(j, n)
        yield i, raw[o[i]:o[j]], o[i:j + 1] - o[i]
        i = j


def word_spans(b: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of word bytes (``is_word``: 256 booleans), cut at text
    ends. Returns starts, ends and, per text, the index of its first word."""
    w = is_word[b]
    first = np.zeros(len(b) + 1, dtype=bool)
    first[offsets] = True
    before = np.empty(len(b) + 1, dtype=bool)
    before[0] = False
    before[1:] = w
    after = np.empty(len(b) + 1, dtype=bool)
    after[:-1] = w
    after[-1] = False
    starts = np.flatnonzero(after & (~before | first))
    ends = np.flatnonzero(before & (~after | first))
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges."""
    n = len(b)
    padded = np.zeros(n + 8, dtype=np.uint8)
    padded[:n] = b
    lanes = np.ndarray((n + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    size = ends - starts
    h = size.astype(np.uint64) * _GOLD
    idx = np.flatnonzero(size <= _LONG_WORD)
    at, left = starts[idx], size[idx]
    acc = h[idx]
    k = 0
    while len(idx):
        lane = lanes[at + 8 * k] & _LANE_MASK[np.minimum(left, 8)]
        acc = mix64((acc ^ lane) + _GOLD)
        more = left > 8
        h[idx[~more]] = acc[~more]
        idx, at, left, acc = idx[more], at[more], left[more] - 8, acc[more]
        k += 1
    for i in np.flatnonzero(size > _LONG_WORD):
        h[i] = xxhash.xxh64_intdigest(padded[starts[i]:ends[i]].tobytes())
    return h


def byte_table(separators: bytes) -> np.ndarray:
    t = np.ones(256, dtype=bool)
    t[list(separators)] = False
    return t


ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32
#: Words are runs without these bytes (space, tab to carriage return).
BLANK_CUT = byte_table(b" \t\n\x0b\x0c\r")
_SHINGLE_MULT = mix64(np.arange(1, 65, dtype=np.uint64) * _GOLD) | np.uint64(1)


def shingle_sets(column: pa.Array, k: int = 5) -> Iterator[np.ndarray]:
    """Per text its sorted distinct ``k``-word shingle hashes: words are cut at
    blanks, A-Z lowered; fewer than ``k`` words make one shingle, none make none."""
    for _, raw, offsets in text_chunks(column):
        b = ASCII_LOWER[raw]
        starts, ends, first = word_spans(b, offsets, BLANK_CUT)
        w = word_hashes(b, starts, ends)
        g = np.zeros(len(w), dtype=np.uint64)
        if len(w) >= k:
            for j in range(k):
                g[:len(w) - k + 1] += w[j:len(w) - k + 1 + j] * _SHINGLE_MULT[j]
            g = mix64(g)
        for t in range(len(offsets) - 1):
            lo, hi = first[t], first[t + 1]
            if hi - lo >= k:
                yield np.unique(g[lo:hi - k + 1])
            elif hi > lo:
                s = np.uint64(hi - lo) * _GOLD
                with np.errstate(over="ignore"):
                    s = s + (w[lo:hi] * _SHINGLE_MULT[:hi - lo]).sum(dtype=np.uint64)
                yield mix64(np.array([s], dtype=np.uint64))
            else:
                yield g[:0]


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """A table of ``rows`` rows of two numbers as the small side of a join: told to
    all executors up to BROADCAST_ROWS, shuffled beyond."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def connected_components(edges: DataFrame, label: str = "cc", known: DataFrame | None = None) -> DataFrame:
    """Components of the undirected graph ``edges(a, b)``: (id, label) for every
    end of an edge, label being the smallest id of the component.

    Labels fall to the least neighbouring label and then jump to the label
    of their label, until none changes. Every round is one hash aggregate
    (partial first, so a hub does not gather) and is stored in the shared
    folder; the driver sees one count per round. ``known(id, label)`` are the
    components of earlier edges: the new edges then run between these, and
    the result covers both.
    """
    if known is not None:
        rows = known.count()
        end = lambda x: bounded(known.select(F.col("id").alias(x), F.col("label").alias(f"label_{x}")), rows)
        ends = edges.join(end("a"), "a", "left").join(end("b"), "b", "left").select(
            F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b")).filter("a <> b")
        top = connected_components(ends, label)
        over = bounded(top.select(F.col("id").alias("label"), F.col("label").alias("over")), top.count())
        old = known.join(over, "label", "left").select("id", F.coalesce("over", "label").alias("label"))
        return store(old.union(top.join(known, "id", "left_anti").select("id", "label")), label)
    both = store(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), label)
    labels = store(both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("label")), label)
    rows = labels.count()
    while True:
        near = both.join(bounded(labels.withColumnRenamed("id", "b"), rows), "b").select(
            F.col("a").alias("id"), "label", F.lit(None).cast("long").alias("was"))
        low = labels.select("id", "label", F.col("label").alias("was")).union(near).groupBy("id").agg(
            F.min("label").alias("label"), F.max("was").alias("was"))
        jump = bounded(labels.select(F.col("id").alias("label"), F.col("label").alias("over")), rows)
        new = store(low.join(jump, "label", "left").select("id", "was", F.least("label", "over").alias("label")), label)
        changed = new.filter("label <> was").limit(1).count()
        labels = new.select("id", "label")
        if not changed:
            return labels


def unsigned(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
