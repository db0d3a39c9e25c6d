"""N-gram Jaccard join by vertical partitioning of the global n-gram order.

Documents are sets of distinct five-word shingles. Two documents link when
``100 * |intersection| >= 75 * |union|``. The join works on classes of equal
sets, so copies are never compared with one another:

1. ``sets``: one pass over the texts gives each document's set size, a
   64-bit class id (a digest of the set) and a signature: the parities of
   the set's shingles by their low bits, two to four bits a shingle.
2. Global order: shingles that a documented sample of classes shows to be
   common come last, all others stand by hash. Any order gives the same
   links; this one keeps common shingles out of the prefixes.
3. Prefixes: of ``n`` shingles the first ``n - ceil(0.75 n) + 1``. The order
   is cut into fragments, each a group of its own, in which buckets of one
   class vanish and buckets with the same members count as one. Every bucket
   first pairs its members with a few centers only (stars, never all
   pairs); a common shingle is not gathered at all, its members are paired
   with the classes that the sample names. Partial overlaps are summed per pair
   over the fragments, and pairs that can still be similar are verified:
   those whose sizes and prefix overlap allow it and whose signatures differ
   in no more places than similar sets differ in shingles (every place
   that differs stands for a shingle of one set alone, so no link is lost).
4. Verification: pairs are dealt into blocks and each class's set into as many
   vertical fragments as the sets of its block need; a (block, fragment) group counts partial overlaps,
   and the counts are summed per pair.
5. Components of the links so far, then two more steps, each of which leaves
   out what the last has joined: a star with many centers, whose prefix overlaps are
   summed, pruned and verified as before, and every pair between components that is
   left. In the last step the prefix overlaps in small buckets are summed exactly; the
   members of a large bucket meet in one task (or part by part) and are compared there
   by signature, and only pairs that may be similar become rows. So no link between different components
   is lost, and pairs inside a component can't change it. The stars
   join large groups of near copies at linear cost.

The texts are read again rather than storing all shingles: hashing is
vectorised and costs less than moving eight bytes per word.

Defined results: null, empty or blank texts have no shingles, link with
nothing and are their own component; repeated rows (also with one doc_id)
are all returned and share a component when they have shingles; a null
doc_id stays null and its component is the smallest id reachable, null if
there is none. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import bounded, connected_components, mix64, shingle_sets, shuffle_width, store

#: Share of classes (1 in SAMPLE) whose shingles are counted for the order.
SAMPLE = 16
#: A shingle is common when the sample holds it this often.
COMMON_IN_SAMPLE = 2
#: So many of the commonest shingles at most are told to the tasks (16 bytes each).
MAX_COMMON = 1 << 18
#: Prefix entries per fragment, pairs per block, vertical fragments that a block has at most and shingles of its pairs in each.
FRAGMENT_ENTRIES = 500_000
BLOCK_PAIRS = 1_000
VERTICAL = 32
PART_SHINGLES = 500_000
#: Documents that a task packs together.
SLICE_ROWS = 2_500
#: Words of 64 bits that a signature has at least.
MIN_WORDS = 8
#: Members of a bucket that each verify the others in a star round.
CENTERS = 5
#: The second star step reads one in so many buckets, with so many times the centers.
KEYS = 8
#: The last step: members of a bucket up to which a join pairs them; for larger buckets, members that a task compares with
#: one another, classes of a bucket in one part, pairs compared at once, and buckets up to which a class names them all,
#: so that a pair is told by one of those it shares only.
JOIN_MEMBERS = 256
DEAL_ENTRIES = 20_000
PART_CLASSES = 2_000
SLAB_PAIRS = 1 << 18
NAMED_KEYS = 64
#: Bytes of class ids and block numbers up to which the list of classes to verify is broadcast; beyond, it is a shuffled join.
BROADCAST_BYTES = 32 << 20

_PERCENT = 75


def _prefix(n: int) -> int:
    return n - -(-n * _PERCENT // 100) + 1


def _class_id(u: np.ndarray) -> int:
    d = mix64(u ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(u))
    return int(mix64(np.array([d], dtype=np.uint64)).view(np.int64)[0])


def _signature(u: np.ndarray) -> np.ndarray:
    """How many shingles fall on each value of the low bits, odd or even, packed into 64-bit words. The number
    of values is a power of two, so halves laid on one another give the signature of half the length."""
    places = max(64 * MIN_WORDS, 1 << (2 * len(u) - 1).bit_length())
    odd = np.bincount((u & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def shingle_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, n, cid, sig, sample): set size, class id, signature, and the
    set itself for the sampled classes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, cid, sig, sample = [], [], [], []
            with np.errstate(over="ignore"):
                for u in shingle_sets(batch.column(1)):
                    c = _class_id(u) if len(u) else 0
                    n.append(len(u))
                    cid.append(c if len(u) else None)
                    sig.append(_signature(u) if len(u) else None)
                    sample.append(u.view(np.int64) if len(u) and (c >> 20) % SAMPLE == 0 else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(cid, pa.int64()),
                 pa.array(sig, pa.list_(pa.int64())), pa.array(sample, pa.list_(pa.int64()))], ["doc_id", "n", "cid", "sig", "sample"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n long, cid long, sig array<long>, sample array<long>")


def _rank(cid: str, seed: int):
    return F.xxhash64(F.lit(seed), cid)


def _common(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Of the commonest sampled shingles: hash (sorted) and CENTERS classes that have it."""
    sampled = sets.filter("sample IS NOT NULL").groupBy("cid").agg(F.first("sample").alias("sample"))
    held = sampled.select("cid", F.explode("sample").alias("g"))
    # Counted alone first: most shingles are in one class only, and these rows are shuffled two numbers wide.
    often = held.groupBy("g").agg(F.count("*").alias("df")).filter(F.col("df") >= COMMON_IN_SAMPLE).orderBy(F.desc("df"), "g").limit(MAX_COMMON)
    rows = (held.join(F.broadcast(often.select("g")), "g").groupBy("g")
            .agg(*[F.min(F.struct(_rank("cid", s), "cid")).alias(f"c{s}") for s in range(CENTERS)])
            .select("g", *[F.col(f"c{s}.cid").alias(f"c{s}") for s in range(CENTERS)]).toPandas())
    g = rows["g"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(g)
    return g[order], np.stack([rows[f"c{s}"].to_numpy(np.int64)[order] for s in range(CENTERS)])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of SLICE_ROWS rows, so that what a task holds at once stays small."""
    for batch in batches:
        for lo in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(lo, SLICE_ROWS)


def _entries(docs: DataFrame, common, fragments: int) -> DataFrame:
    """Prefix entries, packed: one row per batch and fragment of the order.
    Below zero, a row per batch: star pairs of common shingles with their
    number (odd) and the entries of common shingles (even)."""
    spark = docs.sparkSession
    told = spark.sparkContext.broadcast(common)
    width = np.uint64(((1 << 64) - 1) // fragments + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, hot_cid = told.value
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(_slices(batches)):
            seen: set[int] = set()
            keys, cids, hk, hc, star = [], [], [], [], []
            with np.errstate(over="ignore"):
                for u in shingle_sets(batch.column(0)):
                    n = len(u)
                    if not n or (cid := _class_id(u)) in seen:
                        continue
                    seen.add(cid)
                    m = _prefix(n)
                    cold, h = u[:m], ()
                    if len(hot):
                        at = np.minimum(np.searchsorted(hot, u), len(hot) - 1)
                        is_hot = hot[at] == u
                        cold = u[~is_hot][:m]
                        h = at[is_hot][:m - len(cold)]
                    keys.append(cold)
                    cids.append(np.full(len(cold), cid, np.int64))
                    if len(h):
                        hk.append(hot[h].view(np.int64))
                        hc.append(np.full(len(h), cid, np.int64))
                        near, count = np.unique(hot_cid[:, h], return_counts=True)
                        star.append(np.stack([near, np.full(len(near), cid, np.int64), count])[:, near != cid])
            out = []
            if keys:
                k, c = np.concatenate(keys), np.concatenate(cids)
                order = np.argsort(k)
                k, c = k[order], c[order]
                f = (k // width).astype(np.int64)
                short = (((k - f.astype(np.uint64) * width).astype(np.float64) / float(width)) * ((1 << 32) - 1)).astype(np.uint32)
                cut = np.flatnonzero(np.diff(f)) + 1
                for lo, hi in zip(np.r_[0, cut], np.r_[cut, len(k)], strict=True):
                    if hi > lo:
                        out.append((int(f[lo]), short[lo:hi].tobytes(), c[lo:hi].tobytes(), b""))
            own = -2 * (1 + (task << 24) + number)
            if star:
                out.append((own + 1, *(x.tobytes() for x in np.concatenate(star, axis=1))))
            if hk:
                out.append((own, np.concatenate(hk).tobytes(), np.concatenate(hc).tobytes(), b""))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), *(pa.array([x[i] for x in out], pa.binary()) for i in (1, 2, 3))],
                ["frag", "key", "cid", "count"])
    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "frag long, key binary, cid binary, count binary")


def _buckets(pdf: pd.DataFrame) -> pd.DataFrame:
    """One fragment of the order. kind 0: star pair (a, b) and the number of
    shingles it stands for; kind 1: class b in bucket a, which stands for so
    many buckets with the same members; kind 2: class b has common shingle a."""
    col = lambda name, kind: np.concatenate([np.frombuffer(x, dtype=kind) for x in pdf[name]])
    frag = int(pdf["frag"].iloc[0])
    c = col("cid", np.int64)
    if frag < 0:
        pair = frag % 2 == 1
        return pd.DataFrame({"kind": np.full(len(c), 0 if pair else 2, np.int32), "a": col("key", np.int64), "b": c,
                             "count": col("count", np.int64) if pair else np.ones(len(c), np.int64)})
    k = col("key", np.uint32)
    order = np.lexsort((c, k))
    k, c = k[order], c[order]
    keep = np.ones(len(k), dtype=bool)
    keep[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])  # copies met in other batches
    k, c = k[keep], c[keep]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    size = np.diff(np.r_[first, len(k)])
    with np.errstate(over="ignore"):
        member = np.add.reduceat(mix64(c.view(np.uint64)), first)
    _, one, number = np.unique(member, return_index=True, return_counts=True)
    count = np.zeros(len(first), dtype=np.int64)
    count[one] = number
    rows = np.repeat((count > 0) & (size > 1), size)
    k, c, count = k[rows], c[rows], np.repeat(count, size)[rows]
    bucket = np.cumsum(np.r_[False, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
    stars = []
    for seed in range(CENTERS):
        rank = mix64(c.view(np.uint64) ^ mix64(np.array([seed], dtype=np.uint64)))
        head = np.lexsort((rank, bucket))[np.searchsorted(bucket, bucket)]  # the member of least rank
        leaf = c != c[head]
        stars.append(np.stack([c[head][leaf], c[leaf], count[leaf], bucket[leaf]]))
    star = np.unique(np.concatenate(stars, axis=1), axis=1)  # two seeds may choose the same center
    pairs = pd.DataFrame({"a": star[0], "b": star[1], "count": star[2]}).groupby(["a", "b"], as_index=False)["count"].sum()
    return pd.concat([pairs.assign(kind=0), pd.DataFrame({
        "kind": 1, "a": (frag << 32) + k.astype(np.int64), "b": c, "count": count})])[["kind", "a", "b", "count"]].astype({"kind": np.int32})


def _overlaps(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs(a, b, n_a, n_b, doc_a, doc_b)`` of class ids, their sizes and a document of each -> (a, b, n_a, n_b,
    common): sizes of the intersections, counted fragment by fragment and summed per pair."""
    blocks = max(1, pairs.count() // BLOCK_PAIRS)
    dealt = store(pairs.repartitionByRange(blocks, "a", "b").withColumn("block", F.spark_partition_id()), "op4-pairs")
    # As many fragments as the block's sets need: a pair has one row of partial counts for each.
    parts = F.least(F.lit(VERTICAL), 1 + F.sum(F.col("n_a") + F.col("n_b")) / PART_SHINGLES).cast("int")
    dealt = dealt.join(F.broadcast(dealt.groupBy("block").agg(parts.alias("parts"))), "block")
    end = lambda x: F.struct(F.col(x).alias("cid"), F.col(f"doc_{x}").alias("doc_id"))
    wanted = store(dealt.select("block", "parts", F.explode(F.array(end("a"), end("b"))).alias("end")).groupBy("end.cid").agg(
        F.min("end.doc_id").alias("doc_id"), F.collect_set(F.expr(f"block * {VERTICAL + 1}L + parts")).alias("blocks")), "op4-wanted")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = [np.array([(i << 64) // n for i in range(1, n)], dtype=np.uint64) for n in range(1, VERTICAL + 1)]
        for batch in _slices(batches):
            held: dict[tuple[int, int], tuple[list, list, list]] = {}
            with np.errstate(over="ignore"):
                for u, to in zip(shingle_sets(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                    if not len(u):
                        continue
                    c = _class_id(u)
                    for block, parts in (divmod(x, VERTICAL + 1) for x in to):
                        for f, part in enumerate(np.split(u, np.searchsorted(u, cuts[parts - 1]))):
                            if len(part):
                                cids, sizes, segs = held.setdefault((block, f), ([], [], []))
                                cids.append(c)
                                sizes.append(len(part))
                                segs.append(part)
            pack = lambda x, t: np.array(x, dtype=t).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in held], pa.int32()), pa.array([k[1] for k in held], pa.int32()),
                 pa.array([pack(v[0], np.int64) for v in held.values()], pa.binary()), pa.array([pack(v[1], np.int64) for v in held.values()], pa.binary()),
                 pa.array([np.concatenate(v[2]).tobytes() for v in held.values()], pa.binary())], ["block", "frag", "cid", "size", "seg"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    at = wanted.filter("doc_id IS NOT NULL").select("doc_id", "blocks")
    if (at.agg(F.sum(16 + 8 * F.size("blocks"))).first()[0] or 0) <= BROADCAST_BYTES:
        at = F.broadcast(at)
    found = texts.join(at, "doc_id").select("text", "blocks")
    nameless = wanted.filter("doc_id IS NULL")
    if nameless.limit(1).count():  # classes of rows without an id are found by their digest
        digest = texts.filter("doc_id IS NULL").select("text").distinct().mapInArrow(_with_class, "cid long, text string")
        found = found.union(digest.join(nameless, "cid").select("text", "blocks"))
    left = found.mapInArrow(segments, "block int, frag int, cid binary, size binary, seg binary")
    right = dealt.select("block", F.explode(F.expr("sequence(0, parts - 1)")).alias("frag"), "a", "b", "n_a", "n_b")

    def count_common(seg: pd.DataFrame, todo: pd.DataFrame) -> pd.DataFrame:
        parts: dict[int, np.ndarray] = {}
        for cid, size, values in zip(seg["cid"], seg["size"], seg["seg"], strict=True):
            own = np.split(np.frombuffer(values, dtype=np.uint64), np.cumsum(np.frombuffer(size, dtype=np.int64))[:-1])
            parts.update(zip(np.frombuffer(cid, dtype=np.int64).tolist(), own, strict=True))
        none = np.zeros(0, np.uint64)
        out = np.zeros(len(todo), dtype=np.int64)
        for i, (a, b) in enumerate(zip(todo["a"].tolist(), todo["b"].tolist(), strict=True)):
            x, y = parts.get(a, none), parts.get(b, none)
            if len(x) and len(y):
                at = np.searchsorted(x, y)
                at[at == len(x)] = 0
                out[i] = np.count_nonzero(x[at] == y)
        some = out > 0  # a pair without a common shingle anywhere can't link
        return todo.loc[some, ["a", "b", "n_a", "n_b"]].assign(common=out[some])

    partial = left.groupBy("block", "frag").cogroup(right.groupBy("block", "frag")).applyInPandas(
        count_common, "a long, b long, n_a long, n_b long, common long")
    return partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("common").alias("common"))


def _with_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        with np.errstate(over="ignore"):
            cid = [_class_id(u) if len(u) else None for u in shingle_sets(batch.column(0))]
        yield pa.RecordBatch.from_arrays([pa.array(cid, pa.int64()), batch.column(0)], ["cid", "text"])


def _with_sizes(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    rows = reps.count()
    size = lambda x: bounded(reps.select(F.col("cid").alias(x), F.col("n").alias(f"n_{x}")), rows)
    return pairs.join(size("a"), "a").join(size("b"), "b")


def _possible(n_a: str, d_a: str, n_b: str, d_b: str) -> str:
    """Whether sets of these sizes with that many shingles in shared prefix buckets can be similar:
    what lies behind the prefix that ends first adds no more than its set's rest."""
    rest = f"greatest(ceil({n_a} * 0.75), ceil({n_b} * 0.75)) - 1"
    return (f"100 * least({n_a}, {n_b}) >= {_PERCENT} * greatest({n_a}, {n_b}) AND "
            f"{100 + _PERCENT} * (least({d_a}, {d_b}) + {rest}) >= {_PERCENT} * ({n_a} + {n_b})")


def _alike(sig_a: str, sig_b: str) -> str:
    """Whether the signatures differ in no more places than similar sets of sizes n_a and n_b differ in shingles.
    Sets that can be similar have signatures of one length or of its double, which is folded."""
    word = lambda x: f"IF(size({x}) > w, {x}[i] ^ {x}[i + w], {x}[i])"
    # ``w`` stands for the shorter length: a lambda's argument, so that it is found once a pair
    differ = (f"aggregate(array(least(size({sig_a}), size({sig_b}))), 0, (none, w) -> aggregate(sequence(0, w - 1), 0, "
              f"(sum, i) -> sum + bit_count({word(sig_a)} ^ {word(sig_b)})))")
    return f"{100 + _PERCENT} * (n_a + n_b - {differ}) >= {2 * _PERCENT} * (n_a + n_b)"


def _promising(pairs: DataFrame, reps: DataFrame, tried: DataFrame | None = None) -> DataFrame:
    """Sum the partial prefix overlaps of each pair (a, b, count) and keep the pairs that can still be similar
    and aren't ``tried`` yet: (a, b, n_a, n_b, doc_a, doc_b). Pairs that bring their sizes don't look them up."""
    own = [F.first(c).alias(c) for c in ("n_a", "n_b") if c in pairs.columns]
    summed = pairs.groupBy("a", "b").agg(F.sum("count").alias("count"), *own)
    if not own:
        summed = _with_sizes(summed, reps)
    summed = summed.filter(_possible("n_a", "count", "n_b", "count")).select("a", "b", "n_a", "n_b")
    if tried is not None:
        summed = summed.join(tried, ["a", "b"], "left_anti")
    for x in ("a", "b"):
        summed = summed.join(reps.select(F.col("cid").alias(x), F.col("doc_id").alias(f"doc_{x}"), F.col("sig").alias(f"sig_{x}")), x)
    return summed.filter(_alike("sig_a", "sig_b")).select("a", "b", "n_a", "n_b", "doc_a", "doc_b")


def _links(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that are similar enough."""
    return _overlaps(docs, pairs).filter(100 * F.col("common") >= _PERCENT * (F.col("n_a") + F.col("n_b") - F.col("common"))).select("a", "b")


def _star(members: DataFrame, reps: DataFrame, tried: DataFrame) -> DataFrame:
    """Promising pairs of each class with some centers of its buckets, over one in KEYS buckets.
    The class that shares most of its prefix lies in the middle of its group; the other centers are drawn by hash."""
    drawn = members.filter(F.pmod(F.xxhash64("key"), F.lit(KEYS)) == 0)
    ranks = [-F.col("degree") / F.col("n")] + [F.lit(0.0)] * (KEYS * CENTERS - 1)
    center = drawn.groupBy("key").agg(*[
        F.min(F.struct(r, _rank("cid", 100 + s), "cid", "label", "n", "degree")).alias(f"c{s}") for s, r in enumerate(ranks)])
    center = center.select("key", F.explode(F.array_distinct(F.array(*[
        F.struct(f"c{s}.cid", f"c{s}.label", f"c{s}.n", f"c{s}.degree") for s in range(len(ranks))]))).alias("c"))
    pairs = (drawn.join(center, "key").filter("c.label <> label").filter(_possible("n", "degree", "c.n", "c.degree"))
            .select(F.least("cid", "c.cid").alias("a"), F.greatest("cid", "c.cid").alias("b"), (KEYS * F.col("count")).alias("count"),
                    F.expr("IF(cid < c.cid, n, c.n)").alias("n_a"), F.expr("IF(cid < c.cid, c.n, n)").alias("n_b")))
    return _promising(pairs, reps, tried)


def _compare(pdf: pd.DataFrame) -> pd.DataFrame:
    """The pairs of one deal that share a bucket, lie in different components, and whose sizes, shared prefixes and
    signatures allow a link. Slab by slab: what is held at once doesn't grow with the number of pairs."""
    cid, label, n, degree = (pdf[c].to_numpy(np.int64) for c in ("cid", "label", "n", "degree"))
    named = [dict(zip(x.tolist(), y.tolist(), strict=True)) if x is not None else None for x, y in zip(pdf["named"], pdf["counts"], strict=True)]
    small = [int(d) - sum(x.values()) if x is not None else 0 for d, x in zip(degree, named, strict=True)]  # shared in small buckets, at most
    who = np.repeat(np.arange(len(pdf)), [len(x) for x in pdf["key"]])
    key, lo, hi, part = (np.concatenate(pdf[c].to_list()).astype(np.int64) for c in ("key", "lo", "hi", "part"))
    order = np.lexsort((hi, lo, key))
    who, key, lo, hi, part = (x[order] for x in (who, key, lo, hi, part))
    new = np.r_[True, (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]
    stop = np.r_[np.flatnonzero(new)[1:], len(key)][np.cumsum(new) - 1]
    after = stop - np.arange(len(key)) - 1  # members of its bucket that follow each
    words = np.array([len(x) for x in pdf["sig"]])
    place, sigs = np.zeros(len(pdf), np.int64), {}
    for w in np.unique(words).tolist():
        at = np.flatnonzero(words == w)
        place[at], sigs[w] = np.arange(len(at)), np.stack([pdf["sig"].iloc[i] for i in at]).astype(np.int64).view(np.uint64)
    told: dict[tuple[int, int], None] = {}
    total = np.r_[0, np.cumsum(after)]
    start = 0
    while start < len(key):
        end = max(start + 1, int(np.searchsorted(total, total[start] + SLAB_PAIRS, side="right")) - 1)
        i = np.repeat(np.arange(start, end), after[start:end])
        j = i + 1 + np.arange(len(i)) - np.repeat(total[start:end] - total[start], after[start:end])
        start = end
        x, y = who[i], who[j]
        n_x, n_y = n[x], n[y]
        rest = (3 * np.maximum(n_x, n_y) + 3) // 4 - 1
        open_ = ((label[x] != label[y]) & ((lo[i] == hi[i]) | (part[i] != part[j])) & (100 * np.minimum(n_x, n_y) >= _PERCENT * np.maximum(n_x, n_y))
                 & ((100 + _PERCENT) * (np.minimum(degree[x], degree[y]) + rest) >= _PERCENT * (n_x + n_y)))
        i, x, y = i[open_], x[open_], y[open_]
        swap = words[x] > words[y]
        x, y = np.where(swap, y, x), np.where(swap, x, y)
        for w, v in sorted(set(zip(words[x].tolist(), words[y].tolist(), strict=True))):
            pairs = np.flatnonzero((words[x] == w) & (words[y] == v))
            step = max(1, 8 * SLAB_PAIRS // v)
            for at in (pairs[k:k + step] for k in range(0, len(pairs), step)):
                other = sigs[v][place[y[at]]]
                differ = np.bitwise_count(sigs[w][place[x[at]]] ^ (other if v == w else other[:, :w] ^ other[:, w:])).sum(axis=1, dtype=np.int64)
                size = n[x[at]] + n[y[at]]
                for k in at[(100 + _PERCENT) * (size - differ) >= 2 * _PERCENT * size].tolist():
                    p, q = int(x[k]), int(y[k])
                    if named[p] is not None and named[q] is not None:
                        shared = sorted(named[p].keys() & named[q].keys())
                        if shared[int(cid[p] ^ cid[q]) % len(shared)] != key[i[k]]:
                            continue  # told by another bucket
                        most = sum(named[p][s] for s in shared) + min(small[p], small[q]) + (3 * max(int(n[p]), int(n[q])) + 3) // 4 - 1
                        if (100 + _PERCENT) * most < _PERCENT * int(n[p] + n[q]):
                            continue
                    told[(p, q) if cid[p] < cid[q] else (q, p)] = None
    a, b = np.array(list(told), dtype=np.int64).reshape(-1, 2).T
    return pd.DataFrame({"a": cid[a], "b": cid[b], "n_a": n[a], "n_b": n[b]})


def _every(members: DataFrame, reps: DataFrame, tried: DataFrame) -> DataFrame:
    """The pairs of classes that share a bucket, lie in different components, can be similar and aren't ``tried`` yet:
    (a, b, n_a, n_b, doc_a, doc_b). Pairs of small buckets are joined and summed, at most JOIN_MEMBERS / 2 rows for a member;
    a pair that shares small buckets only is summed exactly. The others meet in large buckets."""
    sizes = members.groupBy("key").count().filter(F.col("count") > JOIN_MEMBERS)
    large = store(sizes.select("key", F.ceil(F.col("count") / PART_CLASSES).alias("parts")), "op4-large")
    keys = large.count()
    small = members.join(bounded(large, keys), "key", "left_anti")
    x = small.select("key", F.col("cid").alias("a"), F.col("label").alias("label_a"), F.col("n").alias("n_a"), F.col("degree").alias("d_a"), "count")
    y = small.select("key", F.col("cid").alias("b"), F.col("label").alias("label_b"), F.col("n").alias("n_b"), F.col("degree").alias("d_b"))
    pairs = (x.join(y, "key").filter("a < b AND label_a <> label_b").filter(_possible("n_a", "d_a", "n_b", "d_b"))
             .select("a", "b", "count", "n_a", "n_b"))
    found = _promising(pairs, reps, tried)
    if not keys:
        return found
    return found.union(_large(members.join(bounded(large, keys), "key"), reps, tried)).dropDuplicates(["a", "b"])


def _large(members: DataFrame, reps: DataFrame, tried: DataFrame) -> DataFrame:
    """The same for members of large buckets, whose pairs would be rows by the square of their number: they meet in one
    task, or part by part if they are many, and are compared there by signature, so that only pairs to verify become rows."""
    deals = max(shuffle_width(members.sparkSession), members.count() // DEAL_ENTRIES)
    at = members.withColumn("part", F.expr("pmod(xxhash64(cid, 7), parts)")).withColumn(
        "other", F.explode(F.expr("sequence(0, parts - 1)"))).select(
        "cid", "label", "n", "degree", "key", "part", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"))
    at = at.withColumn("deal", F.pmod(F.xxhash64("key", "lo", "hi"), F.lit(deals)))
    named = members.groupBy("cid").agg(F.count("*").alias("keys"), F.collect_list(F.struct("key", "count")).alias("named")).select(
        "cid", *[F.expr(f"IF(keys <= {NAMED_KEYS}, named.{c}, NULL)").alias(x) for c, x in (("key", "named"), ("count", "counts"))])
    packed = at.groupBy("cid", "deal").agg(
        *[F.first(c).alias(c) for c in ("label", "n", "degree")], F.collect_list(F.struct("key", "lo", "hi", "part")).alias("at"))
    packed = packed.join(named, "cid").join(reps.select("cid", "sig"), "cid").select(
        "deal", "cid", "label", "n", "degree", "sig", "named", "counts", *[F.col(f"at.{c}").alias(c) for c in ("key", "lo", "hi", "part")])
    pairs = packed.groupBy("deal").applyInPandas(_compare, "a long, b long, n_a long, n_b long").dropDuplicates(["a", "b"])
    pairs = pairs.join(tried, ["a", "b"], "left_anti")
    for x in ("a", "b"):
        pairs = pairs.join(reps.select(F.col("cid").alias(x), F.col("doc_id").alias(f"doc_{x}")), x)
    return pairs.select("a", "b", "n_a", "n_b", "doc_a", "doc_b")


def ngram_join(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    sets = store(shingle_classes(docs), "op4-sets")
    reps = store(sets.filter("n > 0").groupBy("cid").agg(F.first("n").alias("n"), F.min("doc_id").alias("doc_id"),
                                                      F.first("sig").alias("sig")), "op4-classes")
    classes, entries = reps.agg(F.count("*"), F.sum(F.expr("n - ceil(n * 0.75) + 1"))).first()
    fragments = max(2, shuffle_width(spark), int(entries or 0) // FRAGMENT_ENTRIES)
    bucket = store(_entries(docs, _common(sets), fragments).groupBy("frag").applyInPandas(
        _buckets, "kind int, a long, b long, count long"), "op4-buckets")
    star = bucket.filter("kind = 0").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "count")
    first = store(_promising(star, reps), "op4-first")
    links = store(_links(docs, first), "op4-links")
    labels = connected_components(links)

    members = store(bucket.filter("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("cid"), "count").union(
        bucket.filter("kind = 2").select("a", "b", "count").dropDuplicates(["a", "b"])), "op4-members")
    # What one step links, the next leaves out: only the last step takes every pair between components.
    for step in (_star, _every):
        named = store(members.join(labels.withColumnRenamed("id", "cid"), "cid", "left")
                      .select("key", "cid", "count", F.coalesce("label", "cid").alias("label")), "op4-named")
        mixed = named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("key")
        named = named.join(mixed, "key", "left_semi")
        # A class shares no more of its prefix with another than with all others together.
        degree = named.groupBy("cid").agg(F.sum("count").alias("degree")).join(bounded(reps.select("cid", "n"), classes), "cid")
        members = store(named.join(degree, "cid"), "op4-open")
        more = store(step(members, reps, first.select("a", "b")), "op4-more")
        if more.limit(1).count():
            labels = connected_components(store(_links(docs, more), "op4-links"), known=labels)
            first = store(first.union(more), "op4-first")
        members = members.select("key", "cid", "count")
    named = sets.select("doc_id", "n", "cid").join(labels.withColumnRenamed("id", "cid"), "cid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "cid").alias("label"))
    least = named.filter("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("least"))
    return named.join(least, "label", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of every component: that with the component's smallest doc_id.
    Of repeated rows with that id the one whose columns have the least digest
    stays, whatever the order of the rows; rows without an id all stay."""
    found = store(ngram_join(docs), "op4-components")
    ids = store(found.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_doc_id")).agg(
        F.count(F.expr("IF(doc_id = component_id, 1, NULL)")).alias("kept")).filter("kept <> 1"), "op4-not-once")
    near = lambda of: F.broadcast(of) if 16 * of.count() <= BROADCAST_BYTES else of
    same = F.col("doc_id").cast("long") == F.col("_doc_id")
    # The ids that go are few against those that stay: told to all tasks, they leave the texts where they are.
    rows = docs.filter(F.col("doc_id").cast("long").isNotNull()).join(near(ids.select("_doc_id")), same, "left_anti")
    again = ids.filter("kept > 1").select("_doc_id")
    if again.limit(1).count():
        # Rows of one digest are alike in every column, so it doesn't matter which of them stays.
        marked = docs.join(near(again), same, "left_semi").withColumn("_digest", F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])), 256))
        least = marked.groupBy(F.col("doc_id").alias("_least_id")).agg(F.min("_digest").alias("_least"))
        again = marked.join(least, (F.col("doc_id") == F.col("_least_id")) & (F.col("_digest") == F.col("_least")), "left_semi")
        rows = rows.union(again.dropDuplicates(["doc_id"]).drop("_digest"))
    return rows.union(docs.filter("doc_id IS NULL"))
