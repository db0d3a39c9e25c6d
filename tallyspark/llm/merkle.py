"""Merkle dataset manifest: a hash tree over all rows, with a proof for every row.

Every row is a leaf; the leaves of one language form a binary tree in the
order of doc_id, and the roots of the languages, in their order, form the
tree whose top is the root of the dataset. A changed row changes the root,
and a row's proof (the sibling digests on its way up) shows that the row
belongs to a root without reading any other row.

How it runs:

* leaves are hashed by Spark's own functions, ordered into ranges
  (``ordered_ranges``) and stored. A range is a *leaf partition*;
* ``build``: each leaf partition hashes up as far as its own leaves reach and
  hands on only the nodes whose sibling lies elsewhere, at most two a level.
  Groups of ``MERGE`` neighbouring partitions then hash on from these, round
  by round, until one group is left, so no task ever sees more than a
  partition's leaves or the edges of ``MERGE`` neighbours;
* ``prove`` is the octopus multiproof: each leaf partition names the minimal
  union of node coordinates that its proofs need and its own leaves do not
  give (``missing``), one join fetches these for all partitions, and each
  partition derives the interiors its leaves share once and expands every
  leaf's own proof from them.

A digest is SHA-256 over its inputs' concatenation, digests as lowercase hex
text. A leaf's inputs are doc_id, source, lang, n_chars and text, each ``-``
if null and else its UTF-8 byte count, ``:`` and the value. Two neighbouring
nodes become their digest; the last node of a level, if it has no neighbour,
becomes the digest of itself alone; a tree of one leaf has that leaf as root.

Odd rows: null languages are a language of their own, the first one; rows
with a null doc_id come first in their language; rows of one doc_id are
ordered by their leaf digest, so that repeated rows (which are leaves of
their own) are interchangeable. An empty table has no leaves and no root.
Extra columns take no part. The number of rows and of languages is not bounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.ordering import ordered_ranges
from tallyspark.session import stored

#: Leaves of one partition (bounds what a task holds).
LEAVES = 1 << 16
#: Neighbouring partitions (then groups of them) whose edges one task merges.
MERGE = 32
_NODE = "tree string, n long, level int, i long, digest binary, part int, open boolean"
_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """The digest of a row (binary)."""
    def told(c: Column) -> Column:
        c = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*[told(c) for c in (doc_id, source, lang, n_chars, text)]), 256))


# ------------------------------------------------------------- trees, locally
def heights(n: int) -> list[int]:
    """The number of nodes on each level of a tree of ``n`` leaves."""
    out = [n]
    while out[-1] > 1:
        out.append((out[-1] + 1) // 2)
    return out


def missing(own: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """The octopus: per level, the coordinates that proofs of the leaves
    ``own`` (sorted) of a tree of ``n`` need and these leaves don't give."""
    for level, size in enumerate(heights(n)[:-1]):
        beside = own ^ 1
        beside = beside[beside < size]
        absent = beside[own[np.minimum(np.searchsorted(own, beside), len(own) - 1)] != beside]
        yield level, absent
        own = np.unique(own >> 1)


def climb(own: np.ndarray, digests: list[str], n: int, given: dict[tuple[int, int], str]) -> tuple[list[np.ndarray], list[list[str]]]:
    """Derive every node above the leaves ``own`` once, with the ``given``
    digests of ``missing``: per level the known coordinates and digests."""
    at, known = [], []
    for level, size in enumerate(heights(n)):
        extra = sorted(i for lv, i in given if lv == level)
        both = np.concatenate([own, np.array(extra, dtype=np.int64)])
        order = np.argsort(both, kind="stable")
        digests = digests + [given[level, i] for i in extra]
        digests = [digests[k] for k in order]
        at.append(both[order])
        known.append(digests)
        if size == 1:
            return at, known
        here, above, k = at[-1].tolist(), [], 0
        while k < len(here):
            pair = k + 1 < len(here) and here[k + 1] == here[k] ^ 1
            above.append(digest(digests[k] + digests[k + 1] if pair else digests[k]))
            k += 2 if pair else 1
        own, digests = np.unique(at[-1] >> 1), above
    return at, known


def siblings(leaves: np.ndarray, n: int, at: list[np.ndarray], known: list[list[str]]) -> list[np.ndarray]:
    """Per level, the place in ``known`` of every leaf's sibling (-1: it has none)."""
    out = []
    for level, size in enumerate(heights(n)[:-1]):
        beside = (leaves >> level) ^ 1
        out.append(np.where(beside < size, np.searchsorted(at[level], beside), -1))
    return out


def fold(leaf: str, path: list[tuple[str | None, bool]]) -> str:
    """A leaf digest carried to the top by its siblings ((digest or None, sibling is on the left))."""
    for beside, left in path:
        leaf = digest(leaf if beside is None else beside + leaf if left else leaf + beside)
    return leaf


# -------------------------------------------------------------------- building
def _hashed_up(nodes: dict[int, dict[int, bytes]], n: int) -> list[dict[int, bytes]]:
    """All nodes that follow from ``nodes`` (level -> coordinate -> digest), with them."""
    out = []
    for level, size in enumerate(heights(n)):
        here = nodes.setdefault(level, {})
        out.append(here)
        if size == 1:
            return out
        above = nodes.setdefault(level + 1, {})
        for i in here:
            if i % 2 == 0 and i // 2 not in above and (i + 1 in here or i + 1 == size):
                above[i // 2] = hashlib.sha256((here[i].hex() + (here[i + 1].hex() if i + 1 in here else "")).encode()).digest()
    return out


def _node_rows(tree, n: int, part: int, levels: list[dict[int, bytes]], keep, rows: dict[str, list]) -> None:
    """The nodes ``keep(level, i, open)`` of a tree; open: the parent does not follow yet."""
    sizes = heights(n)
    for level, here in enumerate(levels):
        for i, d in here.items():
            up = sizes[level] > 1 and i // 2 not in levels[level + 1]
            if keep(level, i, up):
                for name, v in zip(rows, (tree, n, level, i, d, part, up)):
                    rows[name].append(v)


def _table(rows: dict[str, list]) -> pa.Table:
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.bool_())
    return pa.table({name: pa.array(v, type=k) for (name, v), k in zip(rows.items(), kinds)})


def _empty_rows() -> dict[str, list]:
    return {x.split()[0]: [] for x in _NODE.split(", ")}


def _runs(leaves: pa.Table, ranges: pa.Table) -> Iterator[tuple[dict, pa.Table]]:
    """The leaves of one partition in order, tree by tree."""
    leaves, at = leaves.sort_by("_at"), 0
    for r in ranges.sort_by("_low").to_pylist():
        yield r, leaves.slice(at, r["_size"])
        at += r["_size"]


def _edges(leaves: pa.Table, ranges: pa.Table, every: bool) -> pa.Table:
    """A leaf partition hashed up: the nodes that other partitions need, or every node."""
    rows = _empty_rows()
    for r, run in _runs(leaves, ranges):
        first = dict(enumerate(run["leaf"].to_pylist(), r["_before"]))
        levels = _hashed_up({0: first}, r["_total"])
        top = len(levels) - 1
        _node_rows(r["tree"], r["_total"], r["_range"], levels, lambda level, i, up: every or up or level == top, rows)
    return _table(rows)


def _merged(nodes: pa.Table, step: int) -> pa.Table:
    """The edges of neighbouring partitions hashed on: what is new, and what is still open."""
    rows = _empty_rows()
    got = nodes.to_pylist()
    given: dict[int, dict[int, bytes]] = {}
    for x in got:
        given.setdefault(x["level"], {})[x["i"]] = x["digest"]
    old = {(x["level"], x["i"]) for x in got}
    levels = _hashed_up(given, got[0]["n"])
    _node_rows(got[0]["tree"], got[0]["n"], got[0]["part"] // step, levels, lambda level, i, up: up or (level, i) not in old, rows)
    return _table(rows)


def _build(leaves: DataFrame, ranges: DataFrame, every: bool = False) -> DataFrame:
    """The nodes that more than one leaf partition takes part in or needs and
    every root, or ``every`` node: (tree, n, level, i, digest). ``leaves``:
    _range, _at, leaf; ``ranges``: tree, _range, _low, _size, _before, _total."""
    step = MERGE

    def edges(leaves: pa.Table, ranges: pa.Table) -> pa.Table:
        return _edges(leaves, ranges, every)

    def merge(group: pa.Table) -> pa.Table:
        return _merged(group, step)
    new = stored(leaves.select("_range", "_at", "leaf").groupBy("_range").cogroup(ranges.groupBy("_range")).applyInArrow(edges, _NODE), "merkle-edges")
    nodes = new
    while not (rest := new.filter("open")).isEmpty():
        new = stored(rest.withColumn("_group", F.floor(F.col("part") / step)).groupBy("tree", "_group").applyInArrow(merge, _NODE), "merkle-nodes")
        nodes = nodes.unionByName(new)
    return stored(nodes.select("tree", "n", "level", "i", "digest").distinct(), "merkle")


def _root(nodes: DataFrame) -> DataFrame:
    """(tree, root) of every tree."""
    return nodes.groupBy("tree").agg(F.max_by("digest", "level").alias("root"))


@dataclass
class Manifest:
    """The stored tree of a table of documents.

    ``leaves`` (doc_id, tree, leaf, claimed, _range, _at) in leaf partitions;
    ``ranges`` says what these hold and where their languages stand; ``nodes``
    and ``tops`` are the shared nodes of the language trees and of the tree
    over them; ``root`` is the dataset's digest (None without rows).
    """
    leaves: DataFrame
    ranges: DataFrame
    nodes: DataFrame
    tops: DataFrame
    root: str | None


def manifest(docs: DataFrame, claimed: Column | None = None) -> Manifest:
    """Hash all rows into a tree. ``claimed`` is a row digest (binary, null:
    the row's own) that ``prove`` shall hold against the root."""
    own = leaf_digest(*[F.col(c) for c in _FIELDS])
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("tree"), own.alias("leaf"),
                         (F.lit(None) if claimed is None else claimed).cast("binary").alias("claimed"), F.monotonically_increasing_id().alias("tie"))
    leaves, ranges = ordered_ranges(stored(hashed, "merkle-leaves"), ["tree"], ["doc_id", "leaf", "tie"], rows=LEAVES, label="merkle-ordered")
    ranges = stored(ranges, "merkle-ranges")
    nodes = _build(leaves, ranges)
    roots = stored(_root(nodes).select(F.col("tree").alias("lang"), F.col("root").alias("leaf")), "merkle-roots")
    one = F.lit(None).cast("string").alias("tree")
    top_leaves, top_ranges = ordered_ranges(roots, [], ["lang"], rows=LEAVES, label="merkle-langs")
    top_ranges = top_ranges.select(one, "*")
    tops = _build(top_leaves, top_ranges, every=True)  # the partitions that prove are not those of this tree
    root = _root(tops).first()
    places = top_leaves.alias("a").join(top_ranges.alias("b"), "_range").select(
        F.col("a.lang"), (F.col("a._at") - F.col("b._low") + F.col("b._before")).alias("place"), F.col("b._total").alias("places"))
    ranges = stored(ranges.join(places, ranges["tree"].eqNullSafe(places["lang"])).drop("lang"), "merkle-places")
    return Manifest(leaves, ranges, nodes, tops, bytes(root["root"]).hex() if root else None)


# --------------------------------------------------------------------- proving
_NEED = "_range int, top boolean, tree string, level int, i long"


def _needs(ranges: pa.Table) -> pa.Table:
    """The union of missing node coordinates of one leaf partition, in its language trees and in the tree over them."""
    rows = {x.split()[0]: [] for x in _NEED.split(", ")}
    got = ranges.to_pylist()

    def need(top, tree, own, n):
        for level, absent in missing(own, n):
            for i in absent.tolist():
                for name, v in zip(rows, (got[0]["_range"], top, tree, level, i)):
                    rows[name].append(v)
    for r in got:
        need(False, r["tree"], np.arange(r["_before"], r["_before"] + r["_size"]), r["_total"])
    need(True, None, np.unique(np.array([r["place"] for r in got])), got[0]["places"])
    kinds = (pa.int32(), pa.bool_(), pa.string(), pa.int32(), pa.int64())
    return pa.table({name: pa.array(v, type=k) for (name, v), k in zip(rows.items(), kinds)})


_PROOF = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"


def _expand(leaves: pa.Table, side: pa.Table, with_siblings: bool) -> pa.Table:
    """All proofs of one leaf partition from its leaves and the fetched nodes."""
    given: dict = {}
    for x in side.filter(pc.is_valid(side["digest"])).to_pylist():
        given.setdefault(None if x["top"] else (x["tree"],), {})[x["level"], x["i"]] = x["digest"].hex()
    ranges = side.filter(pc.is_null(side["digest"]))
    runs, trees = list(_runs(leaves, ranges)), []
    for r, run in runs:
        own = np.arange(r["_before"], r["_before"] + r["_size"])
        digests = [d.hex() for d in run["leaf"].to_pylist()]
        at, known = climb(own, digests, r["_total"], given.get((r["tree"],), {}))
        trees.append((own, digests, siblings(own, r["_total"], at, known), known))
    out: dict[str, list] = {k: [] for k in ("doc_id", "leaf", "subroot", "proof_sha256", "folded_root", *(["siblings"] if with_siblings else []))}
    if runs:
        place = np.array([r["place"] for r, _ in runs])
        order = np.argsort(place)
        places = runs[0][0]["places"]
        at, top = climb(place[order], [trees[k][3][-1][0] for k in order], places, given.get(None, {}))
        over = siblings(place, places, at, top)
    for k, (r, run) in enumerate(runs):
        own, digests, beside, known = trees[k]
        above = [(top[lv][s[k]] if s[k] >= 0 else None, bool(place[k] >> lv & 1)) for lv, s in enumerate(over)]
        beside = [s.tolist() for s in beside]
        claimed = run["claimed"].to_pylist()
        for j, i in enumerate(own.tolist()):
            path = [(known[lv][s[j]] if s[j] >= 0 else None, bool(i >> lv & 1)) for lv, s in enumerate(beside)] + above
            told = [d for d, _ in path if d is not None]
            out["proof_sha256"].append(digest("".join(told)))
            out["folded_root"].append(fold(digests[j] if claimed[j] is None else claimed[j].hex(), path))
            if with_siblings:
                out["siblings"].append(told)
        out["doc_id"].extend(run["doc_id"].to_pylist())
        out["leaf"].extend(digests)
        out["subroot"].extend([known[-1][0]] * len(own))
    kinds = {"doc_id": pa.int64(), "siblings": pa.list_(pa.string())}
    return pa.table({name: pa.array(v, type=kinds.get(name, pa.string())) for name, v in out.items()})


def prove(m: Manifest, with_siblings: bool = False) -> DataFrame:
    """One row per leaf: doc_id, leaf, subroot (its language's root), root,
    proof_sha256 (digest of its siblings, bottom up), folded_root (its claimed
    digest, or else its own, carried up by the siblings) and verified; on
    request the siblings themselves."""
    needs = m.ranges.groupBy("_range").applyInArrow(_needs, _NEED)
    same = F.expr("a.tree <=> b.tree AND a.level = b.level AND a.i = b.i")
    fetched = [needs.filter("top" if top else "NOT top").alias("a").join(nodes.alias("b"), same)
               .select("a._range", "a.top", "a.tree", "a.level", "a.i", "b.digest") for top, nodes in ((False, m.nodes), (True, m.tops))]
    side = fetched[0].unionByName(fetched[1]).unionByName(m.ranges, allowMissingColumns=True)

    def expand(leaves: pa.Table, side: pa.Table) -> pa.Table:
        return _expand(leaves, side, with_siblings)
    proofs = m.leaves.select("_range", "_at", "doc_id", "leaf", "claimed").groupBy("_range").cogroup(side.groupBy("_range")).applyInArrow(
        expand, _PROOF + (", siblings array<string>" if with_siblings else ""))
    return proofs.select("doc_id", "leaf", "subroot", F.lit(m.root).cast("string").alias("root"), "proof_sha256", "folded_root",
                         (F.col("folded_root") == F.lit(m.root)).alias("verified"), *(["siblings"] if with_siblings else []))


def tampered_leaf(every: int = 7) -> Column:
    """The digest a row would have with n_chars one higher, where ``every``
    divides the CRC-32 of its doc_id; else null."""
    hit = F.crc32(F.col("doc_id").cast("string")) % every == 0
    return F.when(hit, leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text")))
