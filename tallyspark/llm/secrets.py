"""Secret scan: pattern spans, and character Markov models for the rest.

Base spans are found by three patterns (assign, access, hex). The method
adds spans of kind ``random``: runs of at least MIN_RUN characters of
``[A-Za-z0-9+/_=-]`` that overlap no base span and look more like random
strings than like ordinary identifiers. Two first-order Markov models over
characters are compared by the log-likelihood ratio per transition: one is
trained on the secret parts of base spans, the other on runs of letters
outside of base spans (at least MIN_WORD characters), both on samples of at
most SAMPLE_RUNS distinct strings by hash. The threshold is the larger of
MIN_SCORE and the 99.9 % quantile of a fifth of the identifiers that the models
have not seen.

Everything runs in DataFrame expressions. The models are one array of 128 x
128 ratios, the only thing the driver gathers.

Defined results: a null text is empty and has no spans; repeated rows are
scanned each; a null doc_id stays null; without base spans or identifiers
there is no ratio to compare and no span is added. Extra columns are kept by
``redact_secrets`` and ignored by the others.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import store
from tallyspark.llm.spans import match_spans, redact, spans_text

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
MIN_RUN, MIN_WORD = 20, 12
RUN = r"[A-Za-z0-9+/_=-]{%d,}" % MIN_WORD
SAMPLE_RUNS = 20_000
MIN_SCORE = 0.15
_SMOOTHING, _SYMBOLS, _BACK_OFF = 0.5, 67, 4.0
KINDS = ("assign", "access", "hex", "random")


def base_spans(text: Column) -> Column:
    """All base spans. ``{14,}`` and ``{16,}`` keep what the plain runs with a length test keep,
    as such a run is matched whole; an assignment is tested after it is matched."""
    return F.concat(match_spans(text, ASSIGN, "assign", 0, keep=lambda m, v: F.char_length(v) >= 12, group=2),
                    match_spans(text, ACCESS, "access", 1), match_spans(text, HEX, "hex", 2))


def run_spans(text: Column, base: Column) -> Column:
    """Runs outside of base spans: candidates, and the identifiers that the model learns."""
    runs = match_spans(text, RUN, "random", 3)
    return F.filter(runs, lambda r: ~F.exists(base, lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))


@dataclass
class RatioModel:
    """Log-likelihood ratios of transitions, as text of 128 * 128 numbers, and the threshold."""
    ratios: str | None
    threshold: float


def _score(run: Column, ratios: Column) -> Column:
    """Mean log-likelihood ratio of a run's transitions."""
    n = F.char_length(run)
    place = lambda i: F.ascii(run.substr(i, F.lit(1))) * 128 + F.ascii(run.substr(i + 1, F.lit(1)))
    total = F.aggregate(F.sequence(F.lit(1), n - 1), F.lit(0.0), lambda acc, i: acc + F.get(ratios, place(i)))
    return F.when(n > 1, total / (n - 1)).otherwise(F.lit(0.0))


def _array(ratios: str) -> Column:
    return F.split(F.lit(ratios), ",").cast("array<double>")


def train(found: DataFrame) -> RatioModel:
    """From ``found(base, runs)``, the spans of the corpus."""
    secrets = found.select(F.explode("base").alias("s")).select(F.lit(1).alias("label"), F.col("s.value").alias("run"))
    words = (found.select(F.explode("runs").alias("s")).filter(F.col("s.value").rlike("^[A-Za-z]+$"))
             .select(F.lit(0).alias("label"), F.col("s.value").alias("run")))
    draw = lambda x: x.distinct().orderBy(F.xxhash64("run"), "run").limit(SAMPLE_RUNS)
    sample = store(draw(secrets).union(draw(words)).withColumn("held", F.pmod(F.xxhash64(F.lit(5), "run"), F.lit(5)) == 0), "op2-sample")
    step = F.explode(F.transform(F.sequence(F.lit(1), F.char_length("run") - 1), lambda i: F.col("run").substr(i, F.lit(2))))
    pairs = (sample.filter("(label = 1 OR NOT held) AND char_length(run) > 1").select("label", step.alias("pair"))
             .filter(F.col("pair").rlike(r"^[\x21-\x7E]{2}$")))
    counts = pairs.groupBy("pair").agg(F.sum("label").cast("double").alias("secret"), F.sum(1 - F.col("label")).cast("double").alias("word"))
    rows = counts.collect()  # at most 94 * 94 rows
    seen = {(r["pair"][0], r["pair"][1]): (r["word"], r["secret"]) for r in rows}
    first: list[dict[str, float]] = [{}, {}]
    second: list[dict[str, float]] = [{}, {}]
    for (a, b), n in seen.items():
        for k in (0, 1):
            first[k][a] = first[k].get(a, 0.0) + n[k]
            second[k][b] = second[k].get(b, 0.0) + n[k]
    if not any(first[0].values()) or not any(first[1].values()):
        return RatioModel(None, MIN_SCORE)

    def chance(k: int, a: str, b: str) -> float:
        """Of b after a; where a is rare, how common b is at all."""
        common = (second[k].get(b, 0.0) + _SMOOTHING) / (sum(second[k].values()) + _SMOOTHING * _SYMBOLS)
        return (seen.get((a, b), (0.0, 0.0))[k] + _BACK_OFF * common) / (first[k].get(a, 0.0) + _BACK_OFF)

    def ratio(i: int) -> float:
        a, b = chr(i // 128), chr(i % 128)
        return math.log(chance(1, a, b)) - math.log(chance(0, a, b))

    ratios = ",".join(f"{ratio(i):.6g}" for i in range(128 * 128))
    high = sample.filter("label = 0 AND held").select(F.percentile(_score(F.col("run"), _array(ratios)), 0.999)).first()[0]
    return RatioModel(ratios, max(MIN_SCORE, high or 0.0))


def random_spans(runs: Column, model: RatioModel) -> Column:
    if model.ratios is None:
        return F.filter(runs, lambda r: F.lit(False))
    return F.filter(runs, lambda r: (F.char_length(r["value"]) >= MIN_RUN) & (_score(r["value"], _array(model.ratios)) > model.threshold))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, base, runs) of every row, stored."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("base", base_spans(F.col("text")))
    return store(base.select("doc_id", "base", run_spans(F.col("text"), F.col("base")).alias("runs")), "op2-found")


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random)."""
    found = find(docs)
    model = train(found)
    spans = found.select("doc_id", F.array_sort("base").alias("base"), random_spans(F.col("runs"), model).alias("added"))
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return spans.select("doc_id", number("assign"), number("access"), number("hex"),
                        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
                        spans_text(F.array_sort(F.concat("base", "added"))).alias("spans"),
                        F.size("added").cast("long").alias("n_random"))


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret span of ``text`` replaced; ``n_chars``, if there, is counted anew where the text changed."""
    model = train(find(docs))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text.alias("text")).withColumn("base", base_spans(F.col("text")))
    spans = F.array_sort(F.concat("base", random_spans(run_spans(F.col("text"), F.col("base")), model)))
    out = base.select("row", "text", spans.alias("spans")).select("row", "spans", redact(F.col("text"), F.col("spans"), mark).alias("new"))
    hit = F.size("spans") > 0
    columns = []
    for c in docs.columns:
        old = F.col("row").getField(c)
        if c == "text":
            columns.append(F.when(hit, F.col("new")).otherwise(old).alias(c))
        elif c == "n_chars":
            columns.append(F.when(hit, F.char_length("new")).otherwise(old).cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(old.alias(c))
    return out.select(*columns)
