"""The n-gram join's signatures: no similar pair is ruled out, groups of near copies keep every link."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import fixtures as X  # noqa: E402

pytest.importorskip("tallyspark.llm")
from tallyspark.llm import ngram_join  # noqa: E402


def test_signature_halves_fold():
    u = np.random.default_rng(1).integers(0, 1 << 63, 2000, dtype=np.uint64)
    long = ngram_join._signature(u)
    assert len(long) * 64 == 4096 and len(ngram_join._signature(u[:1])) == ngram_join.MIN_WORDS
    half = np.packbits((np.bincount((u & np.uint64(2047)).astype(np.int64), minlength=2048) & 1).astype(bool), bitorder="little")
    assert (np.bitwise_xor(long[:32], long[32:]) == half.view(np.int64)).all()


def test_signatures_rule_out_no_similar_pair(spark):
    rng = np.random.default_rng(7)
    rows, similar = [], []
    for n in (1, 4, 5, 100, 250, 256, 257, 300, 1024, 1030, 5000):  # sizes on both sides of a doubled length
        for missing in (0, 0.05, 0.1, 0.125, 0.14, 0.143, 0.15, 0.25, 0.5, 1):
            for less in (0, 0.1, 0.25):
                u = rng.integers(0, 1 << 63, n, dtype=np.uint64)
                gone = int(n * missing)
                v = np.concatenate([u[gone:], rng.integers(0, 1 << 63, gone, dtype=np.uint64)])[int(n * less):]
                common = len(np.intersect1d(u, v))
                similar.append(100 * common >= 75 * (len(u) + len(v) - common))
                rows.append((len(rows), len(u), len(v), ngram_join._signature(u).tolist(), ngram_join._signature(v).tolist()))
    table = spark.createDataFrame(rows, "pair long, n_a long, n_b long, sig_a array<long>, sig_b array<long>")
    left = {r.pair for r in table.filter(f"100 * least(n_a, n_b) >= 75 * greatest(n_a, n_b) AND ({ngram_join._alike('sig_a', 'sig_b')})").collect()}
    assert {i for i, s in enumerate(similar) if s} <= left
    assert len(left) < 1.3 * sum(similar)  # and few others are verified


def test_group_of_near_copies_keeps_every_link(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for d in range(400):
        w = list(base)
        for _ in range(rng.choice((0, 1, 2, 3, 6))):
            w[rng.randrange(len(w))] = f"x{rng.randrange(40)}"
        texts.append((d, " ".join(w[rng.randrange(4):])))
    table = spark.createDataFrame(texts, "doc_id long, text string")
    assert sorted(map(tuple, ngram_join.ngram_join(table).collect())) == sorted(X.components(texts))
