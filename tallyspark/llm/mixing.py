"""Mixing sources to target weights by a low-discrepancy schedule.

Every source gets a target number of words; the mix is a sequence of slots
of ``BLOCK`` words each, and any stretch of it holds the sources in nearly
their shares.

* ``targets``: weights 5, 2, 1 (repeating) over the sources in code point
  order share 150 % of all words. No source gives more than twice its words;
  what is above goes to the others by weight until none is above.
* ``schedule``: a source needs ceil(target / BLOCK) slots. These needs, one
  after the other, are the cumulative weights on 0..M; slot i stands at the
  van der Corput point of i (its binary digits mirrored, on the smallest
  2^k >= M, points from M on left out) and belongs to the source whose
  stretch the point falls into. The slots of a source are ranked by i.
* ``blocks``: a source's documents, shuffled by a seeded hash, are one stream
  of words, read up to twice; it is cut into blocks of equal size. The last
  block ends at the target, so each source gives exactly its target, rounded.
* ``mix``: the slot of rank k of a source is joined with its block k.

No step gathers a source: ranks and the words before a document come from
``positions`` and ``running_sums`` (range partitions), a source's points are
made in chunks of ``CHUNK``, and the join's key is (source, block), of which
each has one slot and at most BLOCK pieces. The rounds of the resharing are
sums over the stored table of sources; the driver sees two numbers a round.

Odd rows: a null source is a source of its own, the last one; null, empty and
blank texts have no words and are taken 0 times; rows of one doc_id are rows
of their own, ordered by the digest of their text, so repeated rows are
interchangeable; a null doc_id is shuffled like an empty one. Without any
word all targets are 0. An empty table gives no rows. Extra columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.ordering import positions, running_sums
from tallyspark.llm.common import BLANK_CUT, text_chunks, word_spans
from tallyspark.session import stored

#: Weights of the sources in their order, repeating.
WEIGHTS = (5, 2, 1)
#: All targets together, as a share of all words; the most a source gives, as a share of its own.
SHARE, MOST = 1.5, 2
#: Words of a slot.
BLOCK = 512
#: Points that one row makes at a time.
CHUNK = 1 << 16


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sizes = np.zeros(b.num_rows, dtype=np.int64)
        for first, raw, offsets in text_chunks(b.column("text")):
            *_, places = word_spans(raw, offsets, BLANK_CUT)
            sizes[first:first + len(places) - 1] = np.diff(places)
        yield pa.RecordBatch.from_arrays([b.column(c) for c in ("doc_id", "source", "key", "digest", "tie")] + [pa.array(sizes)],
                                         names=["doc_id", "source", "key", "digest", "tie", "size"])


def sized(docs: DataFrame, seed: int = 1) -> DataFrame:
    """(doc_id, source, key, digest, tie, size): the words of every document and its place in the shuffle."""
    key = F.unhex(F.sha2(F.concat(F.lit(f"mix:{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text", F.substring(key, 1, 16).alias("key"),
                       F.xxhash64("text").alias("digest"), F.monotonically_increasing_id().alias("tie"))
    return stored(rows.mapInArrow(_count_words, "doc_id long, source string, key binary, digest long, tie long, size long"), "mix-sizes")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target, place, slots_before, slots) of every source."""
    s = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    # Null last: the order of positions puts nulls first, a flag before it puts them last.
    s = positions(s.withColumn("none", F.col("source").isNull()), [], ["none", "source"], "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    s = stored(s.select("source", "source_size", "place", weight.alias("weight"), (F.col("source_size") * most).alias("most")), "mix-weights")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    capped, level = -1, 0.0
    while True:  # a source above its most stays above while the others' share grows, so the rounds end
        above = F.lit(False) if capped < 0 else F.col("weight") * F.lit(level) >= F.col("most")
        n, given, rest = s.agg(F.count(F.when(above, 1)), F.sum(F.when(above, F.col("most"))), F.sum(F.when(~above, F.col("weight")))).first()
        if n == capped or not rest:
            break
        capped, level = n, (share * total - (given or 0)) / rest
    s = s.withColumn("target", F.least(F.col("weight") * F.lit(level), F.col("most").cast("double")))
    s = s.withColumn("slots", F.ceil(F.round("target") / BLOCK))
    return stored(running_sums(stored(s, "mix-targets"), [], ["place"], "slots", "slots_before"), "mix-needs").select(
        "source", "source_size", "target", "place", "slots_before", "slots")


def _mirrored(x, bits: int):
    """The number whose binary digits (``bits`` of them) are those of ``x`` read backwards."""
    return F.conv(F.reverse(F.lpad(F.bin(x), bits, "0")), 2, 10).cast("long")


def schedule(needs: DataFrame) -> DataFrame:
    """(slot, place, rank): the slots of the mix, ascending with gaps, and their rank among those of their source."""
    m = needs.agg(F.sum("slots")).first()[0] or 0
    bits = max(1, int(m - 1).bit_length()) if m else 1
    last = F.col("slots_before") + F.col("slots") - 1
    chunks = needs.filter("slots > 0").select("place", last.alias("last"), F.explode(F.sequence("slots_before", last, F.lit(CHUNK))).alias("first"))
    points = stored(chunks.repartition("place", "first").select("place", F.explode(F.sequence("first", F.least(F.col("first") + CHUNK - 1, F.col("last")))).alias("point"))
                    .select("place", _mirrored(F.col("point"), bits).alias("slot")), "mix-slots")
    return positions(points, ["place"], ["slot"], "rank")


def blocks(sizes: DataFrame, needs: DataFrame) -> DataFrame:
    """The stream of every source cut into blocks: (doc columns, source_size,
    target, place, block, read, start, length). A piece is ``length`` words
    from word ``start`` of its document; ``read`` is 0 or 1, the time the
    stream is read. A document outside the target has one row without block."""
    d = running_sums(sizes, ["source"], ["key", "doc_id", "digest", "tie"], "size", "before")
    d = d.alias("d").join(needs.alias("n"), F.expr("d.source <=> n.source")).select("d.*", "n.source_size", "n.target", "n.place")
    upto = F.round("target").cast("long")
    reads = F.array(*[F.struct(F.lit(r).alias("read"), (F.col("before") + F.col("source_size") * r).alias("at")) for r in range(MOST)])
    used = F.filter(reads, lambda x: (F.col("size") > 0) & (x["at"] < upto))
    d = d.select("*", F.explode_outer(used).alias("x")).select("*", "x.read", "x.at").drop("x")
    end = F.least(F.col("at") + F.col("size"), upto)
    d = d.select("*", end.alias("end"), F.explode_outer(F.when(F.col("at").isNotNull(), F.sequence(F.floor(F.col("at") / BLOCK), F.floor((end - 1) / BLOCK)))).alias("block"))
    first = F.greatest(F.col("at"), F.col("block") * BLOCK)
    length = F.least(F.col("end"), (F.col("block") + 1) * BLOCK) - first
    return d.select("doc_id", "tie", "size", "source", "source_size", "target", "place", "block", "read", (first - F.col("at")).alias("start"), length.alias("length"))


def mix(docs: DataFrame, seed: int = 1) -> DataFrame:
    """The mix: the pieces of ``blocks`` with their ``slot`` (null where a
    document is not taken). Ordered by (slot, read, start) it is read from
    first to last."""
    sizes = sized(docs, seed)
    needs = targets(sizes)
    slots = schedule(needs).withColumnRenamed("rank", "block")
    return blocks(sizes, needs).join(slots, ["place", "block"], "left")


def taken(mixed: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target of its source, and the words the mix takes of it."""
    words = F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), F.col("length"))), F.lit(0)).cast("long")
    return mixed.groupBy("tie", "doc_id", "size", "source_size", "target").agg(words.alias("taken")).drop("tie")
