"""Distinct counts without a hash table of all values in any task.

A group by (group, value) keeps every pair of a task's input in one hash
table before the shuffle; where the input is compact on disk, one task holds
millions of pairs and spills. Here the rows are dealt by (group, value) and
sorted, and one row of each pair is flagged, so that summed flags are
distinct counts. Sorting runs over parts of the size that AQE aims at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F


def distinct_counts(rows: DataFrame, group: list[str], value: str, name: str, marked: Column | None = None, marked_name: str = "marked") -> DataFrame:
    """(group, ``name``): the distinct values per group, NULLs left out, and
    on request those of them with a row that is ``marked`` (a boolean without NULLs)."""
    order = F.lit(False) if marked is None else marked
    r = rows.where(F.col(value).isNotNull()).select(*group, value, order.alias("_marked"))
    first = F.row_number().over(W.partitionBy(*group, value).orderBy(F.desc("_marked"))) == 1
    r = r.withColumn("_first", first)
    more = [] if marked is None else [F.sum(F.when(F.col("_first") & F.col("_marked"), 1).otherwise(0)).alias(marked_name)]
    return r.groupBy(*group).agg(F.sum(F.when(F.col("_first"), 1).otherwise(0)).alias(name), *more)
