"""The pipeline's stages, each judged on its own input."""

import os
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import fixtures as X  # noqa: E402

import corpus_pipeline  # noqa: E402
from tallyspark.llm import common, quality  # noqa: E402


def test_stages_apply_their_decisions(spark):
    docs = common.read(spark, X.SF, "documents")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(common.store(stage(spark, seen[-1], X.SF), f"test-{name}"))
    for df in seen[:-1]:
        assert df.columns == docs.columns
    good, one, clean, redacted, packed = seen[1:]
    model = quality.train(docs, common.read(spark, X.SF, "labels"))
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in quality.score(docs, model).filter("selected").collect()}
    texts = [(r.doc_id, r.text) for r in good.collect()]
    assert sorted(r.doc_id for r in one.collect()) == sorted({c for _, _, c in X.components(texts)})
    items = [(r.item_id, r.text) for r in common.read(spark, X.SF, "benchmark").collect()]
    texts = [(r.doc_id, r.text) for r in one.collect()]
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in texts} - {d for d, _ in X.item_matches(texts, items)}
    before = {r.doc_id: r.text for r in clean.collect()}
    after = {r.doc_id: r.text for r in redacted.collect()}
    assert before.keys() == after.keys()
    for d, t in before.items():
        told = X.base(X.SECRETS, X.secret_ok, t)[2]
        assert (after[d] == t) == (not told) and not X.base(X.SECRETS, X.secret_ok, after[d])[2]
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == after.keys()
    again = corpus_pipeline.run(spark, X.SF)
    assert sorted(map(tuple, again.drop("sequence_id", "offset").collect())) == sorted(map(tuple, packed.drop("sequence_id", "offset").collect()))


def test_stages_take_odd_rows(spark):
    odd = X.odd_documents(spark, extra=False)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, X.SF).count() >= 1
        assert stage(spark, odd.limit(0), X.SF).count() == 0
    assert odd.filter(F.col("doc_id").isNull()).count() == 2
