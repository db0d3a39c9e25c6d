"""License scan: a trained paragraph classifier, confirmed against templates.

A paragraph is a line; of the paragraphs between blank lines, those of two lines or
more are scanned too, joined, without the lines confirmed alone, and reported at
their first line when confirmed. Its features are the distinct one- to three-word
n-grams (lower-cased runs of letters, digits, ``+``, ``.`` and ``-``) that occur in the
licence templates and hold an informative word, one that is rare among
the paragraphs of the corpus sample, or a whole short form made of common words. A multinomial logistic regression over
these n-grams, trained on the templates, their variants (a word left out,
halves, joined sentences) and at most SAMPLE_PARAGRAPHS paragraphs of the
corpus that hold no template (see CONFIRM) as class ``unknown``, gives the licence family. A paragraph without an
informative word has no feature at all and is ``unknown``; saying so first
spares the rest of the work and changes nothing. A family counts when its
probability exceeds the calibrated threshold: the 99.9 % quantile of the best
family's probability among sampled corpus paragraphs that were held out, and
MIN_PROBABILITY at least. A prediction is confirmed when the paragraph holds
CONFIRM of the word pairs of one of the family's templates.

Everything runs in DataFrame expressions and Spark ML. The weights are one
row per template n-gram and family, a bound set by the templates.

Defined results: null and empty texts have no paragraphs; repeated rows are
scanned each; a null doc_id stays null; equal probabilities and similarities
go to the first name; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import store
from tallyspark.llm.spans import let

# Sentences by which works declare well-known licences.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "mit": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "MIT License", "The MIT License (MIT)", "This project is licensed under the MIT License",
        "Licensed under MIT License", "Released under MIT License"],
    "bsd": [
        "Licensed under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "BSD 3-Clause License", "BSD 2-Clause License"],
    "gpl-2.0": ["This work is licensed under the GNU General Public License, version 2", "GNU General Public License Version 2, June 1991"],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "GNU General Public License Version 3, 29 June 2007"],
    "lgpl": ["Licensed under the GNU Lesser General Public License"],
    "agpl-3.0": ["Licensed under the GNU Affero General Public License, version 3"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "cc-by": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-nd": ["Licensed under CC BY-ND 4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "cc0": ["Released under CC0 1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work"],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
    "all-rights-reserved": ["Copyright the author. All rights reserved", "No part of this publication may be reproduced without the prior written permission of the publisher",
        "All rights reserved"],
}
#: Sentences about licences that declare none.
OTHER = ("The license of the driver was checked at the border", "Please read the terms before you use this", "The software was released in spring",
         "He holds a license", "A new version of the general plan is public", "This work was published by the foundation", "The permission was granted")
#: Bounds of the sample: paragraphs (lines), and documents that they come from.
SAMPLE_PARAGRAPHS, SAMPLE_DOCUMENTS = 4_000, 1_000
MIN_PROBABILITY, CONFIRM, COMMON_SHARE = 0.5, 0.6, 0.002
UNKNOWN = "unknown"
_WORD = r"[\p{L}\p{N}+.-]*[\p{L}\p{N}+]"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def _grams(words: Column, longest: int = 3) -> Column:
    """Distinct n-grams of one to ``longest`` words."""
    def of(w: Column, n: int) -> Column:
        return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " "))
                      ).otherwise(F.array().cast("array<string>"))
    return let(words, lambda w: F.array_distinct(F.concat(*[of(w, n) for n in range(1, longest + 1)])))


def _tree(words: list[str]) -> str:
    """A pattern for ``words`` that tries each first letter once."""
    groups: dict[str, list[str]] = {}
    for w in words:
        groups.setdefault(w[0], []).append(w[1:])
    parts = []
    for ch, rest in sorted(groups.items()):
        more = [r for r in rest if r]
        parts.append(re.escape(ch) + (f"(?:{_tree(more)})" + "?" * (len(more) < len(rest)) if more else ""))
    return "|".join(parts)


def _variants() -> list[tuple[str, str]]:
    """Training paragraphs of every family."""
    out = []
    for family, sentences in TEMPLATES.items():
        for s in [*sentences, " ".join(sentences)]:
            w = s.split()
            # Two words have no variants; they are told more often instead.
            out += [(family, s)] * (3 if len(w) > 2 else 9) + [(family, " ".join(w[:i] + w[i + 1:])) for i in range(len(w)) if len(w) > 5]
    return out + [(UNKNOWN, s) for s in OTHER for _ in range(3)]


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, paragraph, text): the lines with something in them, numbered from 0."""
    lines = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(lines).alias("paragraph", "text")).filter(F.trim("text") != "")


def template_pairs(spark) -> DataFrame:
    """(family, template, gram, size): the word pairs of every template and their number."""
    told = [(f, i, s) for f, sentences in sorted(TEMPLATES.items()) for i, s in enumerate(sentences)]
    pairs = spark.createDataFrame(told, "family string, template int, text string").select("family", "template", F.explode(_pairs("text")).alias("gram")).distinct()
    return pairs.join(pairs.groupBy("family", "template").agg(F.count("*").alias("size")), ["family", "template"])


def _pairs(text: str) -> Column:
    """Distinct word pairs."""
    return F.filter(_grams(_words(F.col(text)), 2), lambda g: g.contains(" "))


class LicenseModel:
    """Weights per n-gram and family, intercepts, informative words and the threshold."""

    def __init__(self, spark, background: DataFrame):
        from pyspark.ml.classification import LogisticRegression
        from pyspark.ml.feature import CountVectorizerModel

        families = sorted(TEMPLATES)
        self.classes = [*families, UNKNOWN]
        told = spark.createDataFrame([(self.classes.index(f), s) for f, s in _variants()], "label int, text string")
        rows = store(background.select(F.lit(len(families)).alias("label"), "text", (F.pmod(F.xxhash64(F.lit(3), "text"), F.lit(4)) == 0).alias("held"))
                     .unionByName(told.withColumn("held", F.lit(False))).withColumn("words", _words(F.col("text"))), "op8-sample")
        n = max(1, background.count())
        template = [t for s in TEMPLATES.values() for t in s]
        grams = spark.createDataFrame([(t,) for t in template], "text string").select(F.explode(_grams(_words(F.col("text")))).alias("gram")).distinct()
        words = {r["gram"] for r in grams.collect()}
        common = {r["w"] for r in rows.filter(F.col("label") == len(families)).select(F.explode(F.array_distinct("words")).alias("w"))
                  .filter(F.col("w").isin([w for w in words if " " not in w])).groupBy("w").count().filter(F.col("count") > max(2.0, COMMON_SHARE * n)).collect()}
        self.informative = sorted(w for w in words if " " not in w and w not in common)
        # A short form of common words alone ("mit license") tells as a whole.
        told_words = [r["w"] for r in spark.createDataFrame([(t,) for t in template], "text string").select(_words(F.col("text")).alias("w")).collect()]
        self.phrases = sorted({" ".join(w) for w in told_words if not any(x in self.informative for x in w)})
        vocabulary = sorted(g for g in words if any(w in self.informative for w in g.split(" ")) or any(f" {f} " in f" {g} " for f in self.phrases))
        if not vocabulary:
            vocabulary, self.informative = sorted(words), sorted(w for w in words if " " not in w)
        vector = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features", minTF=0.0)
        vector = vector.setBinary(True) if hasattr(vector, "setBinary") else vector
        data = vector.transform(rows.withColumn("grams", _grams(F.col("words")))).select("label", "held", "features")
        fitted = LogisticRegression(family="multinomial", regParam=0.0003, elasticNetParam=0.05, maxIter=100, standardization=False).fit(
            data.filter("NOT held").coalesce(1).select(F.col("label").cast("double"), "features"))
        matrix = fitted.coefficientMatrix.toArray()
        self.intercepts = dict(zip(self.classes, (float(v) for v in fitted.interceptVector), strict=True))
        weights = [(g, c, float(matrix[k][j])) for j, g in enumerate(vocabulary) for k, c in enumerate(self.classes) if matrix[k][j]]
        self.weights = spark.createDataFrame(weights, "gram string, family string, weight double")
        self.templates = template_pairs(spark)
        self.threshold = MIN_PROBABILITY
        held = self.classify(store(rows.filter("held").select(F.monotonically_increasing_id().alias("id"), "text").filter(self.gate(F.col("text"))), "op8-held"))
        held_n = rows.filter("held").count()
        best = [r["probability"] for r in held.filter(F.col("family") != UNKNOWN).orderBy(F.desc("probability")).limit(SAMPLE_PARAGRAPHS).collect()]
        allowed = int(0.001 * held_n)
        if len(best) > allowed:
            self.threshold = max(self.threshold, best[allowed])

    def gate(self, text: Column) -> Column:
        """Whether a text may hold an informative word or phrase, alone or before a dot or hyphen."""
        phrases = [r"[^\p{L}\p{N}+]+".join(re.escape(w) for w in f.split(" ")) for f in self.phrases]
        return F.lower(text).rlike(r"(?<![\p{L}\p{N}+.-])(?:" + "|".join([_tree(self.informative), *phrases]) + r")(?![\p{L}\p{N}+])")

    def classify(self, rows: DataFrame) -> DataFrame:
        """``rows(id, text)`` -> (id, family, probability): the likeliest class of each."""
        grams = rows.select("id", _words(F.col("text")).alias("words")).select("id", F.explode(_grams(F.col("words"))).alias("gram"))
        # The weights are one row per template n-gram and family: bounded by the templates.
        sums = grams.join(F.broadcast(self.weights), "gram").groupBy("id", "family").agg(F.sum("weight").alias("weight"))
        all_ = rows.select("id", F.explode(F.array(*[F.struct(F.lit(c).alias("family"), F.lit(v).alias("intercept")) for c, v in self.intercepts.items()])).alias("c"))
        scored = all_.select("id", "c.*").join(sums, ["id", "family"], "left").select("id", "family", (F.col("intercept") + F.coalesce("weight", F.lit(0.0))).alias("z"))
        best = scored.groupBy("id").agg(F.collect_list(F.struct((-F.col("z")).alias("down"), "family")).alias("all"))
        first = best.select("id", F.array_sort("all").alias("all"))
        total = F.aggregate("all", F.lit(0.0), lambda s, c: s + F.exp(F.col("all")[0]["down"] - c["down"]))
        return first.select("id", F.col("all")[0]["family"].alias("family"), F.round(1 / total, 9).alias("probability"))

    def confirm(self, rows: DataFrame) -> DataFrame:
        """``rows(id, text, family)`` -> (id, template, similarity): the share of a template's word pairs that the paragraph holds, the best of the family."""
        grams = rows.select("id", "family", F.explode(_pairs("text")).alias("gram"))
        found = grams.join(F.broadcast(self.templates), ["family", "gram"]).groupBy("id", "template", "size").agg(F.count("*").alias("n"))
        return found.groupBy("id").agg(F.min(F.struct((-F.col("n") / F.col("size")).alias("down"), "template")).alias("b")).select(
            "id", "b.template", F.round(-F.col("b.down"), 9).alias("similarity"))


def train(docs: DataFrame) -> LicenseModel:
    """From the templates and a bounded sample of the corpus' paragraphs: lines of the documents that come first by hash.
    Documents and lines are chosen by hashes alone, so that no text goes to the task that chooses; chosen lines are whole."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id IS NOT NULL")
    few = ids.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCUMENTS)
    # SAMPLE_DOCUMENTS ids: bounded.
    lines = store(paragraphs(docs.join(F.broadcast(few), docs["doc_id"].cast("long") == few["doc_id"], "left_semi"))
                  .select("text", F.xxhash64("text").alias("key")), "op8-lines")
    keys = lines.select("key").distinct().orderBy(F.xxhash64(F.lit(1), "key"), "key").limit(SAMPLE_PARAGRAPHS)
    drawn = store(lines.dropDuplicates(["key"]).join(F.broadcast(keys), "key", "left_semi"), "op8-drawn")
    declares = (drawn.select("key", F.explode(_pairs("text")).alias("gram")).join(F.broadcast(template_pairs(docs.sparkSession)), "gram")
                .groupBy("key", "family", "template", "size").agg(F.count("*").alias("n")).filter(F.col("n") >= CONFIRM * F.col("size")).select("key"))
    return LicenseModel(docs.sparkSession, store(drawn.join(declares, "key", "left_anti").select("text"), "op8-background"))


def scan(docs: DataFrame, model: LicenseModel | None = None) -> DataFrame:
    """(doc_id, paragraph, family, probability, template, similarity, confirmed) of every paragraph found to declare a licence."""
    model = model or train(docs)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    some = store(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).filter(model.gate(F.col("text")))
                 .withColumn("row", F.monotonically_increasing_id()), "op8-documents")
    # The lines are filtered inside the array: only those with an informative word become rows.
    lines = F.transform(F.split("text", "\n"), lambda t, i: F.struct(i.alias("paragraph"), t.alias("text")))
    single = _named(model, some.select("row", "doc_id", F.explode(F.filter(lines, lambda p: model.gate(p["text"]))).alias("p")).select("row", "doc_id", "p.*"))
    single = store(single, "op8-lines")
    done = single.filter("confirmed").groupBy("row").agg(F.collect_set("paragraph").alias("done"))
    joined = _named(model, _joined(some.join(done, "row", "left")).filter(model.gate(F.col("text")))).filter("confirmed")
    return single.unionByName(joined).drop("row")


def _joined(docs: DataFrame) -> DataFrame:
    """(row, doc_id, paragraph, text) of the paragraphs between blank lines: two lines or more, joined, without those in ``done``."""
    # Cut before every blank line, so that only the first line of a piece can be blank.
    pieces = docs.select("row", "doc_id", F.coalesce("done", F.array().cast("array<bigint>")).alias("done"), F.split("text", r"\n(?=[^\S\n]*(?:\n|$))").alias("pieces"))
    sized = pieces.withColumn("sizes", F.transform("pieces", lambda t: F.size(F.split(t, "\n"))))
    each = sized.select("row", "doc_id", "done", "sizes", F.posexplode("pieces").alias("i", "piece")).filter(F.col("piece").contains("\n"))
    first = F.aggregate(F.slice("sizes", 1, F.col("i")), F.lit(0), lambda n, x: n + x)
    left = each.select("row", "doc_id", "done", first.alias("first"), F.split("piece", "\n").alias("lines")).select("row", "doc_id", F.filter(
        F.transform("lines", lambda t, j: F.struct((F.col("first") + j).cast("long").alias("paragraph"), t.alias("text"))),
        lambda p: (F.trim(p["text"]) != "") & ~F.array_contains("done", p["paragraph"])).alias("left"))
    return left.filter(F.size("left") > 1).select("row", "doc_id", F.col("left")[0]["paragraph"].alias("paragraph"), F.array_join(F.col("left.text"), " ").alias("text"))


def _named(model: LicenseModel, rows: DataFrame) -> DataFrame:
    """``rows(row, doc_id, paragraph, text)`` that the model finds to declare a licence, held against the templates."""
    found = store(rows.withColumn("id", F.monotonically_increasing_id()), "op8-paragraphs")
    named = found.join(model.classify(found).filter((F.col("family") != UNKNOWN) & (F.col("probability") >= model.threshold)), "id")
    named = store(named, "op8-named")
    return named.join(model.confirm(named), "id", "left").select(
        "row", "doc_id", F.col("paragraph").cast("long").alias("paragraph"), "family", "probability", F.coalesce("template", F.lit(-1)).alias("template"),
        F.coalesce("similarity", F.lit(0.0)).alias("similarity"), F.coalesce(F.col("similarity") >= CONFIRM, F.lit(False)).alias("confirmed"))
