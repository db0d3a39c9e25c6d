"""Fill-in-middle transformation: documents cut in three, the middle moved to the end.

A text is a sequence of units (a run of ASCII letters, or any other single
code point). Two hashed places cut it into prefix, middle and suffix, and the
parts are written as ``<P>prefix<S>suffix<M>middle`` (form psm) or
``<S>suffix<P>prefix<M>middle`` (spm), or the text stays as it is (plain).

The cut is one match of a regular expression made for the row:
``regexp_count`` gives the number n of units, and a pattern with the counted
possessive groups ``unit{a}`` and ``unit{b-a}`` captures prefix, middle and
suffix, which the replacement writes in the order of the form. Possessive
counted groups are matched in a loop, without backtracking or recursion, so
the length of a text is bounded by memory alone. Everything is a Spark
expression over one row: no shuffle, no Python.

Texts that hold a mark themselves stay plain, so a form can always be undone
(``restore``): no mark can arise across a seam, as no mark begins with the
end of another.

Odd rows: a null text is empty; an empty text is plain. A null doc_id hashes
like an empty one. Repeated rows are transformed alike. Extra columns are
kept by ``transform`` unless they bear the name of a new one, which wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One unit: matched left to right.
UNIT = "[A-Za-z]+|[^A-Za-z]"
_ONE = "(?:[A-Za-z]++|[^A-Za-z])"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 texts, so many are transformed; of 100 of these, so many suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
_WRITTEN = {"psm": f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2", "spm": f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"}


def _hash(k: int, seed: int) -> Column:
    """The k-th group of eight hex digits of the hash of seed and doc_id, as a number."""
    told = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(told, 8 * k - 7, 8), 16, 10).cast("long")


def transform(docs: DataFrame, seed: int = 1) -> DataFrame:
    """``docs`` with n (units), form, output, prefix_chars and middle_chars
    (code points, null where plain)."""
    text = F.coalesce("text", F.lit(""))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(text, F.lit(mark))
    d = docs.withColumn("n", F.regexp_count(text, F.lit(UNIT)).cast("long"))
    x, y = (F.expr("n + 1") for _ in range(2))
    x, y = _hash(1, seed) % x, _hash(2, seed) % y
    plain = (text == "") | marked | (_hash(3, seed) % 100 >= TRANSFORMED)
    form = F.when(plain, F.lit("plain")).when(_hash(4, seed) % 100 < SUFFIX_FIRST, F.lit("spm")).otherwise(F.lit("psm"))
    d = d.withColumns({"form": form, "_a": F.least(x, y), "_b": F.greatest(x, y)})
    pattern = F.concat(F.lit(f"(?s)\\A({_ONE}{{"), F.col("_a").cast("string"), F.lit(f"}}+)({_ONE}{{"), (F.col("_b") - F.col("_a")).cast("string"), F.lit("}+)(.*)\\z"))
    written = F.when(F.col("form") == "psm", F.lit(_WRITTEN["psm"])).otherwise(F.lit(_WRITTEN["spm"]))
    d = d.withColumn("output", F.when(F.col("form") == "plain", text).otherwise(F.regexp_replace(text, pattern, written)))
    at = {m: F.locate(m, F.col("output")) for m in (PREFIX, SUFFIX, MIDDLE)}
    prefix = F.when(F.col("form") == "psm", at[SUFFIX] - at[PREFIX] - 3).when(F.col("form") == "spm", at[MIDDLE] - at[PREFIX] - 3)
    middle = F.when(F.col("form") != "plain", F.char_length("output") - at[MIDDLE] - 2)
    return d.withColumns({"prefix_chars": prefix.cast("long"), "middle_chars": middle.cast("long")}).drop("_a", "_b")


def restore(output: Column, form: Column) -> Column:
    """The exact text from an output and its form."""
    psm = F.regexp_replace(output, F.lit(f"(?s)\\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*)\\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(f"(?s)\\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*)\\z"), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(transformed: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the SHA-256 of the output and of the text restored from it."""
    return transformed.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                              F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
