"""Spans of regular expressions in whole texts, as DataFrame expressions.

Positions are code points. Splitting a text at a pattern and extracting its
matches give the same leftmost, non-overlapping matches; their lengths,
summed up in turn, are the positions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Matches that are summed up in one inner pass; keeps the work on a text with many matches far below its square.
_BLOCK = 256


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


def match_spans(text: Column, pattern: str, kind: str, rank: int, keep: Callable[[Column, Column], Column] | None = None,
                group: int | None = None) -> Column:
    """Array of struct(start, rank, end, kind, match, value) of the matches for which ``keep(match, value)`` holds.

    ``value`` is the given group of the match (the match itself by default).
    """
    fields = "array<struct<start:bigint,rank:int,end:bigint,kind:string,match:string,value:string>>"
    gaps = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = matches if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rows = F.arrays_zip(gaps.alias("gap"), matches.alias("match"), values.alias("value"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["match"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"),
                        x["match"].alias("match"), x["value"].alias("value"))
        return F.struct(F.coalesce(end, start).cast("bigint").alias("at"),
                        F.when(x["match"].isNull(), acc["found"]).otherwise(F.concat(acc["found"], F.array(span))).alias("found"))

    def block(rows: Column, acc: Column, i: Column) -> Column:
        inner = F.aggregate(F.slice(rows, i * _BLOCK + 1, _BLOCK), F.struct(acc["at"].alias("at"), F.array().cast(fields).alias("found")), add)
        return let(inner, lambda r: F.struct(
            r["at"].alias("at"), F.concat(acc["found"], F.filter(r["found"], lambda s: keep(s["match"], s["value"])) if keep else r["found"]).alias("found")))

    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(fields).alias("found"))
    found = let(rows, lambda r: F.aggregate(F.sequence(F.lit(0), F.floor((F.size(r) - 1) / _BLOCK).cast("int")), zero, lambda acc, i: block(r, acc, i))["found"])
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(fields))


def spans_text(spans: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def merged(spans: Column) -> Column:
    """Sorted (start, end) intervals that cover sorted spans, overlaps joined."""
    kind = "array<struct<start:bigint,end:bigint>>"
    one = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))

    def add(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return (F.when(F.size(acc) == 0, F.array(one(s)))
                .when(s["start"] < last["end"], F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(grown)))
                .otherwise(F.concat(acc, F.array(one(s)))))
    return F.aggregate(spans, F.array().cast(kind), add)


def redact(text: Column, spans: Column, mark: str) -> Column:
    """The text with every covered interval replaced by ``mark``."""
    def add(acc: Column, s: Column) -> Column:
        piece = text.substr((acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(s["end"].alias("at"), F.concat(acc["out"], piece, F.lit(mark)).alias("out"))
    done = F.aggregate(merged(spans), F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")), add,
                       lambda acc: F.concat(acc["out"], text.substr((acc["at"] + 1).cast("int"), F.char_length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
