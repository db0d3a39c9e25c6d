"""The Merkle manifest, the fill-in-middle transformation and the source mix against brute force."""

import hashlib
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import fixtures as X  # noqa: E402

from tallyspark.llm import common, infill, merkle, mixing  # noqa: E402


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def key(x):
    return tuple((v is None, v) for v in x)


# ------------------------------------------------------------------------ op11
def leaf(r, more=0):
    n = None if r.n_chars is None else r.n_chars + more
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, n, r.text)))


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k:k + 2])) for k in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, i):
    return [((nodes[(i >> lv) ^ 1] if (i >> lv) ^ 1 < len(nodes) else None), (i >> lv) & 1) for lv, nodes in enumerate(levels[:-1])]


def proofs(rows):
    first = lambda v: (v is not None, v.encode() if isinstance(v, str) else v)
    groups = defaultdict(list)
    for r in rows:
        groups[r.lang].append(r)
    langs = sorted(groups, key=first)
    for g in langs:
        groups[g].sort(key=lambda r: (first(r.doc_id), leaf(r)))
    trees = [tree([leaf(r) for r in groups[g]]) for g in langs]
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, g in enumerate(langs):
        for i, r in enumerate(groups[g]):
            way = path(trees[k], i) + path(top, k)
            bad = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            h = leaf(r, 1) if bad else leaf(r)
            for beside, left in way:
                h = sha(h if beside is None else beside + h if left else h + beside)
            out.append((r.doc_id, leaf(r), trees[k][-1][0], top[-1][0], sha("".join(d for d, _ in way if d)), h, h == top[-1][0]))
    return out


def proved(docs, **kw):
    return [tuple(r) for r in merkle.prove(merkle.manifest(docs, merkle.tampered_leaf()), **kw).collect()]


def test_proofs_of_documents_and_odd_rows(spark):
    docs = common.read(spark, X.SF, "documents")
    assert sorted(proved(docs)) == sorted(proofs(docs.collect()))
    odd = X.odd_documents(spark)
    got = proved(odd)
    assert sorted(got, key=key) == sorted(proofs(odd.collect()), key=key)
    assert {r[-1] for r in got} == {True, False}
    assert proved(X.empty(odd)) == []


def test_proofs_over_many_partitions_and_rounds(spark, monkeypatch):
    """Ranges of a few leaves, merged three at a time: one large language, many of one row, some of a few."""
    monkeypatch.setattr(merkle, "LEAVES", 20)
    monkeypatch.setattr(merkle, "MERGE", 3)
    rng = random.Random(2)
    rows = [(i, f"text {i}", "big", None, 5) for i in range(301)] + [(i, "x", f"l{i:04d}", "s", None) for i in range(90)]
    rows += [(rng.randrange(9), "again", rng.choice([None, "é", "zz", "😀"]), "s", 1) for _ in range(60)]
    docs = spark.createDataFrame(rows, X.DOCS)
    got = sorted(proved(docs), key=key)
    assert got == sorted(proofs(docs.collect()), key=key)
    m = merkle.manifest(docs)
    assert m.leaves.select("_range").distinct().count() >= 15
    assert all(r.verified and len(r.siblings) <= 17 for r in merkle.prove(m, with_siblings=True).collect())


def test_one_row_and_languages_of_one_row(spark):
    for rows in ([(1, "a", "en", "s", 1)], [(1, "a", "en", "s", 1), (2, "b", None, "s", 1), (3, "c", "fr", "s", 1)]):
        docs = spark.createDataFrame(rows, X.DOCS)
        assert sorted(proved(docs)) == sorted(proofs(docs.collect()))


@pytest.mark.parametrize("n", [1, 2, 3, 7, 13, 64, 97])
def test_missing_is_the_smallest_sufficient_union(n):
    rng = np.random.default_rng(n)
    levels = tree([sha(str(i)) for i in range(n)])
    for size in {1, min(n, 2), max(1, n // 3), n}:
        own = np.sort(rng.choice(n, size=size, replace=False))
        need = [(lv, int(i)) for lv, absent in merkle.missing(own, n) for i in absent]
        derivable = [{int(i) >> lv for i in own} for lv in range(len(levels))]
        want = {(lv, (i >> lv) ^ 1) for lv in range(len(levels) - 1) for i in map(int, own)
                if (i >> lv) ^ 1 < len(levels[lv]) and (i >> lv) ^ 1 not in derivable[lv]}
        assert len(need) == len(set(need)) and set(need) == want
        at, known = merkle.climb(own, [levels[0][i] for i in own], n, {(lv, i): levels[lv][i] for lv, i in need})
        assert known[-1] == [levels[-1][0]]
        assert all(levels[lv][i] == d for lv in range(len(at)) for i, d in zip(at[lv].tolist(), known[lv]))


# ------------------------------------------------------------------------ op12
def infilled(doc_id, text):
    text = text or ""
    u = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = sha(f"1:{'' if doc_id is None else doc_id}")
    hs = [int(h[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((hs[0] % (len(u) + 1), hs[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or hs[2] % 100 >= 90:
        return doc_id, len(u), "plain", None, None, sha(text), sha(text)
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if hs[3] % 100 < 20 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return doc_id, len(u), form, len(p), len(m), sha(out), sha(text)


def test_infill_against_slices(spark):
    docs = common.read(spark, X.SF, "documents").select("doc_id", "text")
    odd = X.odd_documents(spark).select("doc_id", "text")
    tricky = ["a<S", "<", "<P", "P>x", "<P>", "no <M> here", "$1 \\ $2 \\E \\Q", "a\r\nb c\n", "😀é" * 50, "<<S", "\x00", "x<\n>", "}{2}+", "A" * 5000 + "!"]
    many = spark.createDataFrame([(100 + i, tricky[i % len(tricky)] + "<" * (i % 3)) for i in range(280)], "doc_id long, text string")
    rows = docs.union(odd).union(many)
    got = [tuple(r) for r in infill.digests(infill.transform(rows)).collect()]
    want = [infilled(r.doc_id, r.text) for r in rows.collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert infill.digests(infill.transform(X.empty(X.odd_documents(spark)))).count() == 0


def test_infill_of_very_long_texts(spark):
    """A million units and one word of a million letters: counted groups neither recurse nor backtrack."""
    rows = [(i, t) for i in range(8) for t in ("a b" * 350_000, "z" * 1_000_000)]
    got = [tuple(r) for r in infill.digests(infill.transform(spark.createDataFrame(rows, "doc_id long, text string"))).collect()]
    assert sorted(got) == sorted(infilled(*r) for r in rows)


def test_infill_keeps_the_columns(spark):
    odd = X.odd_documents(spark).withColumn("n", F.lit("clash"))
    out = infill.transform(odd)
    assert set(odd.columns) <= set(out.columns) and dict(out.dtypes)["n"] == "bigint"


# ------------------------------------------------------------------------ op13
def aims(sizes):
    """{source: (size, target)}, the excess reshared round by round."""
    order = sorted(sizes, key=lambda s: (s is None, s and s.encode()))
    w = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, left, full = 1.5 * sum(sizes.values()), set(sizes), {}
    while left:
        share = (total - sum(full.values())) / sum(w[s] for s in left)
        above = {s for s in left if share * w[s] > 2 * sizes[s]}
        if not above:
            return {s: (sizes[s], full.get(s, share * w[s])) for s in sizes}
        full |= {s: 2 * sizes[s] for s in above}
        left -= above
    return {s: (sizes[s], full[s]) for s in sizes}


def check_mix(rows, docs):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for r in docs:
        sizes[r.source] += words(r.text)
    want = aims(sizes)
    assert sorted(((r.doc_id, r.size, r.source_size) for r in rows), key=key) == sorted(((r.doc_id, words(r.text), sizes[r.source]) for r in docs), key=key)
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    got, target = Counter(), {}
    for r in rows:
        target[r.source_size] = r.target
        got[r.source_size] += r.taken
    by_size = defaultdict(list)
    for n, t in want.values():
        by_size[n].append(t)
    for n, ts in by_size.items():
        assert any(abs(target[n] - t) < 1e-6 * max(1, t) for t in ts)
        assert abs(got[n] - sum(ts)) <= 0.5 * len(ts) + 1e-6


def test_mix_of_documents_and_odd_rows(spark):
    docs = common.read(spark, X.SF, "documents")
    odd = X.odd_documents(spark)
    for d in (docs, odd):
        rows = mixing.taken(mixing.mix(d)).collect()
        check_mix(rows, d.collect())
        again = mixing.taken(mixing.mix(d.repartition(7))).collect()
        assert sorted(map(tuple, rows), key=key) == sorted(map(tuple, again), key=key)
    assert mixing.taken(mixing.mix(X.empty(odd))).count() == 0
    blank = spark.createDataFrame([(1, None, "a", "a", 1), (2, " ", "b", "b", 1)], X.DOCS)
    assert [(r.size, r.target, r.taken) for r in mixing.taken(mixing.mix(blank)).collect()] == [(0, 0.0, 0)] * 2


def test_pieces_tile_the_streams_and_slots_are_spread(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    monkeypatch.setattr(mixing, "CHUNK", 50)
    rng = random.Random(8)
    docs = spark.createDataFrame([(i, " ".join("w" * rng.randrange(0, 30)), "en", "hot" if rng.random() < .6 else f"s{rng.randrange(9)}", 1) for i in range(400)], X.DOCS)
    pieces = mixing.mix(docs).collect()
    used = [r for r in pieces if r.slot is not None]
    assert all(r.slot is not None for r in pieces if r.block is not None)
    per_slot, places = Counter(), defaultdict(set)
    for r in used:
        per_slot[r.slot] += r.length
        assert r.length > 0 and r.start + r.length <= r["size"]
        for k in range(r.start, r.start + r.length):
            place = (r.doc_id, r["read"], k)
            assert place not in places[r.place]
            places[r.place].add(place)
    target = {r.place: r.target for r in used}
    assert all(abs(len(v) - target[p]) <= 0.5 for p, v in places.items())
    short = [s for s, n in per_slot.items() if n < 16]
    assert max(per_slot.values()) == 16 and len(short) <= len(target)
    # Any stretch of the schedule holds each source within a few slots of its share.
    order = sorted({(r.slot, r.place) for r in used})
    whole = Counter(p for _, p in order)
    for upto in range(1, len(order) + 1, 7):
        now = Counter(p for _, p in order[:upto])
        assert all(abs(now[p] - whole[p] * upto / len(order)) <= 4 for p in whole)
