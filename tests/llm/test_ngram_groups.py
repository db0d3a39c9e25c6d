"""The n-gram join at large groups: pairs don't become rows before they are worth it, texts aren't shuffled to drop a few."""

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import fixtures as X  # noqa: E402

pytest.importorskip("tallyspark.llm")
from tallyspark.llm import ngram_join  # noqa: E402


@pytest.fixture
def conf(spark):
    """Sets session values for one test."""
    was = {}

    def put(k, v):
        was.setdefault(k, spark.conf.get(k))
        spark.conf.set(k, v)
    yield put
    for k, v in was.items():
        spark.conf.set(k, v)


def near_copies(number, edits, seed=5):
    """Texts that differ from one another in about as many shingles as a link allows, some more, some less."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(80)]
    texts = []
    for d in range(number):
        w = list(base)
        for _ in range(rng.choice(edits)):
            w[rng.randrange(len(w))] = f"x{d}_{rng.randrange(40)}"
        texts.append((d, " ".join(w)))
    return texts


def made(df, name):
    """Rows out of the plan's nodes of that name; needs adaptive execution off."""
    df.collect()
    todo, rows = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.nodeName().startswith(name):
            rows += node.metrics().apply("pythonNumRowsReceived").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return rows


@pytest.mark.parametrize("slab, named", [(1 << 18, 64), (50, 0)])
def test_large_buckets_are_compared_in_parts(spark, monkeypatch, slab, named):
    """Every link between components is found, whether a bucket fits a part or not."""
    monkeypatch.setattr(ngram_join, "JOIN_MEMBERS", 8)
    monkeypatch.setattr(ngram_join, "PART_CLASSES", 30)
    monkeypatch.setattr(ngram_join, "SLAB_PAIRS", slab)
    monkeypatch.setattr(ngram_join, "NAMED_KEYS", named)
    texts = near_copies(150, (2, 3, 4)) + [(1000 + d, t + " end") for d, t in near_copies(60, (1, 3, 5), seed=6)]
    table = spark.createDataFrame(texts, "doc_id long, text string")
    assert sorted(map(tuple, ngram_join.ngram_join(table).collect())) == sorted(X.components(texts))


def test_pairs_of_a_large_bucket_are_told_once_if_alike(spark, monkeypatch):
    """Every member shares 40 buckets with every other; of the pairs only those that may be similar become rows, once each."""
    monkeypatch.setattr(ngram_join, "JOIN_MEMBERS", 8)
    texts = near_copies(100, (1, 1, 8, 9))
    table = spark.createDataFrame(texts, "doc_id long, text string")
    sets = ngram_join.shingle_classes(table).dropDuplicates(["cid"]).select("cid", "n", "doc_id", "sig").cache()
    keys = spark.range(40).withColumnRenamed("id", "key")
    members = sets.crossJoin(keys).selectExpr("cid", "key", "1L AS count", "cid AS label", "40L AS degree", "n")
    tried = spark.createDataFrame([], "a long, b long")
    got = ngram_join._every(members, sets, tried).select("a", "b").collect()
    doc = {r.cid: set(X.shingles(X.words(texts[r.doc_id][1]))) for r in sets.collect()}
    links = {(a, b) for a in doc for b in doc if a < b and 100 * len(doc[a] & doc[b]) >= 75 * len(doc[a] | doc[b])}
    assert links and links <= set(map(tuple, got)) and len(got) == len(set(got))
    assert len(got) < len(doc) * (len(doc) - 1) // 4


def test_a_pair_has_one_row_of_partial_counts_if_its_block_is_small(spark, conf, monkeypatch):
    conf("spark.sql.adaptive.enabled", "false")
    texts = near_copies(40, (1, 2))
    table = spark.createDataFrame(texts, "doc_id long, text string").cache()
    sets = ngram_join.shingle_classes(table).dropDuplicates(["cid"]).select("cid", "n", "doc_id").cache()
    pairs = sets.alias("x").crossJoin(sets.alias("y")).selectExpr(
        "x.cid AS a", "y.cid AS b", "x.n AS n_a", "y.n AS n_b", "x.doc_id AS doc_a", "y.doc_id AS doc_b").filter("a < b").cache()
    whole = ngram_join._overlaps(table, pairs)
    assert made(whole, "FlatMapCoGroupsInPandas") == pairs.count()
    monkeypatch.setattr(ngram_join, "PART_SHINGLES", 2000)  # the counts don't depend on the fragments
    cut = ngram_join._overlaps(table, pairs)
    assert made(cut, "FlatMapCoGroupsInPandas") > 2 * pairs.count()
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, cut.collect()))


def test_deduplicate_does_not_shuffle_the_texts(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    texts = near_copies(30, (0, 1, 40))
    table = spark.createDataFrame([*texts, (None, "no id")], "doc_id long, text string")
    kept = ngram_join.deduplicate(table)
    assert "Exchange hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()
    want = {c for d, _, c in X.components(texts) if d == c}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(want)
    assert kept.filter("doc_id IS NULL").count() == 1
