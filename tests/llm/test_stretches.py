"""Fingerprints around shared shingles only: the same matches as fingerprints everywhere."""

import os
import random
import sys

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import fixtures as X  # noqa: E402

from tallyspark.llm import decontaminate as D  # noqa: E402


def made(seed):
    """Items of many sizes, and documents with passages of them, edited, cut off, joined and repeated."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(900)]
    items = [(k, " ".join(rng.choices(vocab, k=rng.choice([6, 9, 17, 30, 41, 64, 120])))) for k in range(40)]
    docs = []
    for d in range(150):
        words = rng.choices(vocab, k=rng.randrange(0, 200))
        for _ in range(rng.randrange(3)):
            part = rng.choice(items)[1].split()
            for _ in range(rng.randrange(4)):
                part[rng.randrange(len(part))] = rng.choice(vocab)
            if rng.random() < .3:
                part = part[:max(1, len(part) - rng.randrange(6))]
            if rng.random() < .2:
                part = part[rng.randrange(6):]
            at = rng.choice([0, len(words), rng.randrange(len(words) + 1)])
            words[at:at] = part
        docs.append((d, " ".join(words)))
    return items, docs


@pytest.mark.parametrize("seed", range(6))
def test_stretches_change_no_match(monkeypatch, seed):
    items, docs = made(seed)
    told = D.Items(items)
    column = pa.array([t for _, t in docs], pa.string())
    got = D.matches(told, column)
    monkeypatch.setattr(D, "_hits", lambda items, w: np.arange(max(1, len(w))))
    assert got == D.matches(told, column)
    want = X.item_matches(docs, items)
    assert len(want - {(t, i) for t, i, *_ in got}) <= 0.02 * len(want) and len(want) > 20


def test_short_steps_and_texts_without_hits(monkeypatch):
    items, docs = made(9)
    told, column = D.Items(items), pa.array([t for _, t in docs] + [None, "", "nothing of it at all here"], pa.string())
    whole = D.matches(told, column)
    monkeypatch.setattr(D, "STEP_WORDS", 37)
    assert D.matches(told, column) == whole
    assert D.matches(D.Items([]), column) == [] and D.matches(D.Items([(1, "too short")]), column) == []
