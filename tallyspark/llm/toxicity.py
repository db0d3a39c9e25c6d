"""Toxicity: a lexicon trie met by Levenshtein automata, with context-window scores.

The lexicon is learned from labelled documents (at most SAMPLE_ROWS of the
training fold, by a hash of doc_id; of near copies one counts): whole words
and word beginnings that are much more frequent in toxic documents, by the
log-likelihood ratio and by precision. SEEDS are always in it.

A word is matched by walking the intersection of the lexicon trie with a
Levenshtein automaton: a state is a set of (trie node, edits), states are
made when first reached, and a word that can no longer match is dropped at
once. Words of 5 letters or more may differ by one edit, of 9 or more by two; word
beginnings must be exact, as must words whose misspellings are mostly harmless
words in the training documents. Workers remember the words they have met.

Every hit is scored by what its kind of match is worth in the training
documents and by a window of WINDOW words on either side: quotation marks or words
of reporting make it count less, words of address and other hits more. A
logistic regression over the summed score, the best hit and the density
gives the probability; neither labels nor lang, source or doc_id enter it.

Defined results: a null or empty text has no hits and the score of such a
text; rows with null labels aren't used, repeated labels count each; a null doc_id is never held out. Extra columns are
ignored. Without a toxic and a harmless label the regression stays at its
starting weights.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import store

#: Labelled training documents that are used, at most.
SAMPLE_ROWS = 12_000
FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
MAX_TERMS, MIN_DOCS, MIN_RATIO, MIN_PRECISION = 400, 5, 20.0, 0.9
BEGINNINGS = (4, 5, 6, 7, 8)
WINDOW = 6
CACHE_WORDS = 250_000
SEEDS = ("idiot", "moron", "imbecile", "scumbag", "worthless", "bastard", "asshole", "bitch", "retard", "dumbass")
ADDRESS = frozenset("you your you're youre u ur du dich dein tu toi vous ton te usted eres are such".split())
REPORT = frozenset("said says quote quoted quotes wrote called term word words dit cite mot sagte zitat wort dijo cita palabra".split())
QUOTES = frozenset("\"'“”„«»‘’`")
_EDGE = "\"'“”„«»‘’`.,;:!?()[]{}*#&%$|<>-_~…¿¡"
_PART = re.compile(r"[^\W_]+")


class Matcher:
    """Words of a lexicon, also misspelled; ``match`` gives (term, kind) or None."""

    def __init__(self, words: list[str], beginnings: list[str], exact: frozenset[str] = frozenset()):
        self.exact = exact
        self.children: list[dict[str, int]] = [{}]
        self.word: list[str | None] = [None]
        self.beginning: list[str | None] = [None]
        self.allowed: list[int] = [0]  # edits that some word below a node may have
        for term in sorted(set(words)):
            self._put(term, self.word, self.edits(term))
        for term in sorted(set(beginnings)):
            self._put(term, self.beginning, 0)
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.next: list[dict[str, int]] = []
        self.ends: list[tuple[str, str] | None] = []
        self.begun: list[tuple[str, str] | None] = []
        self.start = self._state({(0, 0)})

    def edits(self, term: str) -> int:
        return 0 if len(term) < 5 or term in self.exact else 1 if len(term) < 9 else 2

    def _put(self, term: str, marks: list, edits: int) -> None:
        node = 0
        self.allowed[0] = max(self.allowed[0], edits)
        for ch in term:
            if ch not in self.children[node]:
                self.children[node][ch] = len(self.children)
                for column, empty in ((self.children, {}), (self.word, None), (self.beginning, None), (self.allowed, 0)):
                    column.append(empty)
            node = self.children[node][ch]
            self.allowed[node] = max(self.allowed[node], edits)
        marks[node] = term

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        todo = list(pairs)
        least: dict[int, int] = {}
        while todo:  # letters of the term that the word leaves out
            node, e = todo.pop()
            if e > self.allowed[node] or least.get(node, 9) <= e:
                continue
            least[node] = e
            todo += [(c, e + 1) for c in self.children[node].values()]
        key = frozenset(least.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.next.append({})
            ends = [(e, self.word[n]) for n, e in key if self.word[n] and e <= self.edits(self.word[n])]
            begun = [self.beginning[n] for n, e in key if self.beginning[n] and not e]
            self.ends.append((min(ends)[1], "word" if not min(ends)[0] else "near") if ends else None)
            self.begun.append((max(begun, key=len), "beginning") if begun else None)
        return self.states[key]

    def match(self, word: str) -> tuple[str, str] | None:
        state, begun = self.start, None
        for ch in word:
            follow = self.next[state].get(ch)
            if follow is None:
                pairs = set()
                for node, e in self.sets[state]:
                    pairs.add((node, e + 1))
                    for c, child in self.children[node].items():
                        pairs.add((child, e + (c != ch)))
                follow = self.next[state][ch] = self._state(pairs)
            state = follow
            if not self.sets[state]:
                return begun
            begun = self.begun[state] or begun
        return self.ends[state] or begun


class Known(dict):
    """What a blank-separated word matches, looked up once."""

    def __init__(self, matcher: Matcher):
        super().__init__()
        self.matcher = matcher

    def __missing__(self, word: str):
        found = None
        bare = word.strip(_EDGE)
        if bare:
            found = self.matcher.match(bare)
            if found is None and not bare.isalnum():
                found = next((m for p in _PART.findall(bare) if (m := self.matcher.match(p)) and m[1] != "near"), None)
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = found
        return found


@dataclass
class ToxicityModel:
    words: list[str]
    beginnings: list[str]
    exact: frozenset[str] = frozenset()
    worth: dict[str, float] = field(default_factory=lambda: {"word": 0.95, "beginning": 0.95, "near": 0.7})
    weights: tuple[float, ...] = (-3.5, 1.5, 3.0, 0.5)
    _known: Known | None = field(default=None, repr=False, compare=False)

    def hits(self, text: str) -> tuple[list[str], list[tuple[int, str, str]]]:
        """The words of a text and (place, term, kind) of its hits."""
        if self._known is None:
            self._known = Known(Matcher(self.words, self.beginnings, self.exact))
        words = text.lower().split()
        known = self._known
        found = list(map(known.__getitem__, words))
        return words, [(i, *f) for i, f in enumerate(found) if f] if any(found) else []

    def features(self, text: str) -> tuple[float, float, float, int]:
        """Summed and best hit scores (logarithm of one plus), hits in a hundred words, number of hits."""
        words, hits = self.hits(text)
        total = best = 0.0
        last = None
        for k, (i, _, kind) in enumerate(hits):
            near = words[max(0, i - WINDOW):i] + words[i + 1:i + 1 + WINDOW]
            value = self.worth[kind]
            quoted = words[i][0] in QUOTES and words[i].rstrip(".,;:!?")[-1] in QUOTES and len(words[i]) > 2
            if quoted or not REPORT.isdisjoint(w.strip(_EDGE) for w in near):
                value *= 0.3
            elif not ADDRESS.isdisjoint(near):
                value *= 1.25
            if last is not None and i - last <= WINDOW or k + 1 < len(hits) and hits[k + 1][0] - i <= WINDOW:
                value *= 1.25
            last = i
            total += value
            best = max(best, value)
        return math.log1p(total), math.log1p(best), 100.0 * len(hits) / max(20, len(words)), len(hits)

    def score(self, text: str) -> tuple[float, int]:
        a, b, c, n = self.features(text)
        w = self.weights
        return 1 / (1 + math.exp(-(w[0] + w[1] * a + w[2] * b + w[3] * min(c, 10.0)))), n


def _terms(text: str) -> tuple[set[tuple[str, bool]], tuple[int, int]]:
    """The words of a text, with False, and their beginnings, with True; and two
    minimal hashes of the words, which near copies share."""
    words = {w.strip(_EDGE) for w in text.lower().split()}
    words = {w for w in words if w.isalpha() and 3 <= len(w) <= 40}
    out = {(w, False) for w in words}
    out.update((w[:k], True) for w in words for k in BEGINNINGS if len(w) > k)
    low = tuple(min((xxhash.xxh64_intdigest(w, seed=s) for w in words), default=0) >> 1 for s in (1, 2))
    return out, low


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    chosen = (labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("toxic"))
              .filter(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) != HELD_OUT)
              .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(SAMPLE_ROWS))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = [_terms(t.as_py())[1] for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x[0] for x in low], pa.int64()), pa.array([x[1] for x in low], pa.int64())],
                                             ["doc_id", "toxic", "text", "low1", "low2"])
    # At most SAMPLE_ROWS labels: small enough to send to every task.
    found = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text").mapInArrow(
        run, "doc_id long, toxic int, text string, low1 long, low2 long")
    stored = store(found, "op1-sample")
    first = stored.groupBy("low1", "low2", "toxic").agg(F.min("doc_id").alias("doc_id"))
    return store(stored.join(first, ["low1", "low2", "toxic", "doc_id"], "left_semi").select("doc_id", "toxic", "text")
                 .repartition(max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "doc_id"), "op1-sample")


def _lexicon(sample: DataFrame) -> tuple[list[str], list[str]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def rows() -> pa.RecordBatch:
            keys = list(seen[0].keys() | seen[1].keys())
            out = pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()),
                 pa.array([seen[1][k] for k in keys], pa.int64()), pa.array([seen[0][k] for k in keys], pa.int64())],
                ["term", "beginning", "toxic", "other"])
            seen[0].clear()
            seen[1].clear()
            return out
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                seen[toxic].update(_terms(text.as_py())[0])
                if len(seen[0]) + len(seen[1]) > 200_000:
                    yield rows()
        yield rows()

    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(1) or not n.get(0):
        return sorted(SEEDS), []
    t, o = F.col("toxic"), F.col("other")
    share = n[1] / (n[0] + n[1])
    part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    ratio = 2 * (part(t, (t + o) * share) + part(o, (t + o) * (1 - share)))
    terms = (sample.select("toxic", "text").mapInArrow(count, "term string, beginning boolean, toxic long, other long")
             .groupBy("term", "beginning").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
             .filter((t >= MIN_DOCS) & (t >= MIN_PRECISION * (t + o))).withColumn("ratio", ratio).filter(F.col("ratio") >= MIN_RATIO)
             .orderBy(F.desc("ratio"), F.desc(F.length("term")), "beginning", "term").limit(20 * MAX_TERMS).collect())
    words, beginnings = set(SEEDS), set()
    for r in terms:
        if len(words) + len(beginnings) >= MAX_TERMS:
            break
        if any(r["term"].startswith(b) for b in beginnings) or r["beginning"] and any(w.startswith(r["term"]) for w in words):
            continue
        (beginnings if r["beginning"] else words).add(r["term"])
    return sorted(words), sorted(beginnings)


def _regression(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton's method with a small ridge."""
    a = np.c_[np.ones(len(x)), x]
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        ridge = np.diag([1e-6, 0.05, 0.05, 0.05])
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -2, 2)
    return tuple(float(v) for v in w)


def train(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Lexicon, worth of the kinds of matches, and regression, from a bounded sample of the training fold."""
    sample = _sample(docs, labels)
    model = ToxicityModel(*_lexicon(sample))
    told = sample.sparkSession.sparkContext.broadcast(model)

    def kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [sorted({(k, t if k == "near" else "") for _, t, k in told.value.hits(text.as_py())[1]}) for text in batch.column(1)]
            rows = [(y, *x) for y, found in zip(batch.column(0).to_pylist(), out, strict=True) for x in found]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[j] for r in rows], pa.string()) for j in (1, 2))],
                                             ["toxic", "kind", "term"])

    # Of three kinds, one with a row for each lexicon word.
    found = sample.select("toxic", "text").mapInArrow(kinds, "toxic int, kind string, term string").groupBy("kind", "term").agg(
        F.sum("toxic").alias("t"), F.count("*").alias("n")).collect()
    # A word whose misspellings are mostly harmless words must be met exactly.
    model.exact = frozenset(r["term"] for r in found if r["kind"] == "near" and r["t"] + 1 < 0.5 * (r["n"] + 2))
    for kind, start in model.worth.items():
        rows = [r for r in found if r["kind"] == kind and r["term"] not in model.exact]
        model.worth[kind] = (sum(r["t"] for r in rows) + 6 * start) / (sum(r["n"] for r in rows) + 6)
    model._known = None
    told = sample.sparkSession.sparkContext.broadcast(model)

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [told.value.features(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([r[j] for r in rows], pa.float64()) for j in range(3))],
                                             ["doc_id", "toxic", "a", "b", "c"])

    rows = sample.mapInArrow(numbers, "doc_id long, toxic int, a double, b double, c double").collect()  # SAMPLE_ROWS at most
    rows.sort()
    if len({r["toxic"] for r in rows}) == 2:
        x = np.array([[r["a"], r["b"], min(r["c"], 10.0)] for r in rows])
        model.weights = _regression(x, np.array([r["toxic"] for r in rows], dtype=float))
    return model


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_hits) of every row."""
    told = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [told.value.score(t.as_py() or "") for t in batch.column(2)]
            s = pa.array([x[0] for x in out], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), s, pa.array([int(x[0] >= THRESHOLD) for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int64())],
                ["doc_id", "held_out", "score", "predicted", "n_hits"])

    held = F.pmod(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held_out"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int, n_hits long")
