"""Personal data: high-recall generators, gradient-boosted trees, calibrated redaction.

Base spans come from four patterns with checks (email, ip, card, phone).
Two wide generators propose spans that may overlap them and each other:
runs of digits with any separators, and names joined to a host by ``@`` or an
``(at)``. Every candidate is described by format (digits, groups, separators,
brackets) and context (neighbouring characters, telling words before it), each
binned to a few values. The candidates of the whole corpus are counted by
these values, as many rows as there are combinations, and boosted trees are
fitted on the counts to tell candidates that are base spans from others.
The threshold is calibrated on the candidates of held-out documents: the
lowest score at which the precision among all candidates of at least that score is
PRECISION. Candidates beyond it that overlap no base span are added with
kind ``pii``: they look like personal data, but fail a check (a card with a
wrong digit, a telephone number without its plus sign).

Everything runs in DataFrame expressions and Spark ML; the trees are applied
as a CASE expression. The driver gathers one row per distinct combination.

Defined results: a null text is empty; repeated rows are scanned each; a null
doc_id stays null; with no positive or no negative candidate nothing is
added; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import store
from tallyspark.llm.spans import match_spans, spans_text

_LOCAL = r"[A-Za-z0-9._%+-]"
#: A match starts where its first run of characters starts, or where the last match ended;
#: saying so keeps the patterns linear on long runs without changing a match.
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
NUMBERS = r"[+(]?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,}+"
ADDRESSES = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++(?:@|\x20?[(\[](?:at|AT)[)\]]\x20?)[A-Za-z0-9.-]+"
KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.9
TREES, DEPTH, HELD_OUT = 8, 3, 4
_TELLING = r"(?i)(mail|phone|tel|call|fax|card|visa|iban|account|address|contact|ssn|host|ip)[^A-Za-z0-9]{0,3}$"
FEATURES = ("address", "digits", "longest", "dots", "spaces", "hyphens", "plus", "bracket", "before", "after", "telling")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    d = F.reverse(_digits(m))
    at = lambda i: d.substr(i, F.lit(1)).cast("int")
    twice = lambda i: at(i) * 2 - F.when(at(i) > 4, 9).otherwise(0)
    total = F.aggregate(F.sequence(F.lit(1), F.char_length(d)), F.lit(0), lambda s, i: s + F.when(i % 2 == 1, at(i)).otherwise(twice(i)))
    return F.when(F.char_length(d).between(12, 19), total % 10 == 0).otherwise(F.lit(False))


def _octets(m: Column) -> Column:
    def small(p: Column) -> Column:
        bare = F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.when(F.char_length(bare) <= 3, bare.cast("int") <= 255).otherwise(F.lit(False))
    return F.forall(F.split(m, r"\."), small)


def base_spans(text: Column) -> Column:
    return F.concat(match_spans(text, EMAIL, "email", 0), match_spans(text, IP, "ip", 1, keep=lambda m, v: _octets(m)),
                    match_spans(text, CARD, "card", 2, keep=lambda m, v: _luhn(m)),
                    match_spans(text, PHONE, "phone", 3, keep=lambda m, v: F.char_length(_digits(m)).between(9, 15)))


def _candidates(text: Column) -> Column:
    """Generated spans, by place, and each with its neighbourhood."""
    made = F.array_sort(F.concat(match_spans(text, NUMBERS, "pii", 4), match_spans(text, ADDRESSES, "pii", 5)))
    return F.transform(made, lambda s: F.struct(
        s["start"].alias("start"), F.lit(4).alias("rank"), s["end"].alias("end"), F.lit("pii").alias("kind"), s["match"].alias("match"), (s["rank"] == 5).alias("address"),
        text.substr(F.greatest(s["start"] - 19, F.lit(1)).cast("int"), F.least(s["start"], F.lit(20)).cast("int")).alias("left"),
        text.substr((s["end"] + 1).cast("int"), F.lit(1)).alias("right")))


def _features(c: Column) -> dict[str, Column]:
    """Format and context of a candidate, each as a small number."""
    m = c["match"]
    count = lambda p, most: F.least(F.char_length(F.regexp_replace(m, p, "")), F.lit(most))
    longest = F.array_max(F.transform(F.split(m, "[^0-9]+"), lambda g: F.char_length(g)))
    near = lambda x: F.when(x == "", 0).when(x.rlike(r"^[A-Za-z0-9]"), 2).when(x.rlike(r"^\s"), 0).otherwise(1)
    return {
        "address": c["address"].cast("int"), "digits": count("[^0-9]", 21), "longest": F.least(longest, F.lit(17)), "dots": count("[^.]", 4),
        "spaces": count(r"[^\x20]", 4), "hyphens": count("[^-]", 4), "plus": m.startswith("+").cast("int"), "bracket": m.contains("(").cast("int"),
        "before": near(F.right(c["left"], F.lit(1))), "after": near(c["right"]), "telling": c["left"].rlike(_TELLING).cast("int")}


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, base, made): base spans and candidates with their features and whether they are base spans."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", F.array_sort(base_spans(F.col("text"))).alias("base"), _candidates(F.col("text")).alias("made"))
    described = F.transform("made", lambda c: F.struct(
        c["start"].alias("start"), c["rank"].alias("rank"), c["end"].alias("end"), c["kind"].alias("kind"),
        F.exists("base", lambda b: (b["start"] == c["start"]) & (b["end"] == c["end"])).alias("positive"),
        F.struct(*[v.cast("int").alias(k) for k, v in _features(c).items()]).alias("f")))
    span = lambda b: F.struct(b["start"].alias("start"), b["rank"].alias("rank"), b["end"].alias("end"), b["kind"].alias("kind"))
    return store(rows.select("doc_id", F.transform("base", span).alias("base"), described.alias("made")), "op7-found")


@dataclass
class TreeModel:
    """Boosted trees (nested (feature, cut, low, high) or a number) with weights, and the margin from which spans are added."""
    trees: list[tuple[float, object]]
    margin: float | None

    def expression(self, f: Column) -> Column:
        def node(t) -> Column:
            if not isinstance(t, tuple):
                return F.lit(t)
            name, cut, low, high = t
            return F.when(f[name] <= cut, node(low)).otherwise(node(high))
        return sum((w * node(t) for w, t in self.trees), F.lit(0.0))

    def value(self, row: dict) -> float:
        def node(t) -> float:
            while isinstance(t, tuple):
                t = t[2] if row[t[0]] <= t[1] else t[3]
            return t
        return sum((w * node(t) for w, t in self.trees), 0.0)


def _read_trees(told: str) -> list[tuple[float, object]]:
    """The trees in Spark ML's printed form of a model."""
    lines = [x.strip() for x in told.splitlines()]
    at = 0

    def node():
        nonlocal at
        line = lines[at]
        at += 1
        if line.startswith("Predict:"):
            return float(line.split(":")[1])
        name, cut = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        low = node()
        at += 1  # the line that starts with Else
        return FEATURES[int(name)], float(cut), low, node()
    out = []
    while at < len(lines):
        weight = re.match(r"Tree \d+ \(weight (\S+)\)", lines[at])
        at += 1
        if weight:
            out.append((float(weight[1]), node()))
    return out


def train(found: DataFrame) -> TreeModel:
    """Boosted trees and their threshold, from the counted candidates of the whole corpus."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    held = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(HELD_OUT)) == 0
    one = found.select(held.alias("held"), F.explode("made").alias("c")).select(
        "held", F.col("c.positive").cast("double").alias("label"), *[F.col(f"c.f.{k}").alias(k) for k in FEATURES])
    counted = store(one.groupBy("held", "label", *FEATURES).agg(F.count("*").cast("double").alias("n")), "op7-counts")
    sums = {r["label"]: r["n"] for r in counted.filter("NOT held").groupBy("label").agg(F.sum("n").alias("n")).collect()}
    if not sums.get(0.0) or not sums.get(1.0):
        return TreeModel([], None)
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(counted.filter("NOT held")).select("features", "label", "n")
    fitted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=32, weightCol="n", seed=7).fit(rows.coalesce(1))
    model = TreeModel(_read_trees(fitted.toDebugString), None)
    test: dict[float, list[float]] = {}
    for r in counted.filter("held").collect():  # one row for each combination of binned values
        got = test.setdefault(round(model.value(r.asDict()), 9), [0.0, 0.0])
        got[0] += r["n"] * r["label"]
        got[1] += r["n"]
    good = total = 0.0
    for margin in sorted(test, reverse=True):
        good, total = good + test[margin][0], total + test[margin][1]
        if good >= PRECISION * total and margin > 0:
            model.margin = margin
    return model


def added_spans(model: TreeModel) -> Column:
    """Candidates (column ``made``) beyond the threshold that overlap no base span and no earlier added one."""
    if model.margin is None:
        return F.filter("made", lambda c: F.lit(False))
    return F.filter("made", lambda c: (F.round(model.expression(c["f"]), 9) >= math.floor(model.margin * 1e9) / 1e9 - 1e-9) & ~F.exists(
        "base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)."""
    found = find(docs)
    rows = found.select("doc_id", "base", F.transform(added_spans(train(found)), lambda c: F.struct(
        c["start"].alias("start"), c["rank"].alias("rank"), c["end"].alias("end"), c["kind"].alias("kind"))).alias("added"))
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return rows.select("doc_id", *[number(k) for k in KINDS], F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
                       spans_text(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"))
