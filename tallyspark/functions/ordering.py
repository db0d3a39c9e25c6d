"""Distributed ordering: the place of every row in a total order, group by group.

A window ordered over a whole group sorts that group in one task. Here the
rows are range-partitioned by (group, order), sorted inside the ranges and
stored; each range then only has to know how many rows (or how much of a
value) its groups hold in earlier ranges. That is one row per range and group
in it, so the window over these rows stays small whatever the input holds,
and a group with a third of all rows is spread over as many ranges as it
fills.

Rows equal in all order columns fall into one range; where rows can repeat
without bound, add a column that tells them apart as the last order column.
Null groups are groups of their own; nulls come first in ascending order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from tallyspark.session import stored

#: Rows of one range; there are as many ranges as that needs, and at least spark.sql.shuffle.partitions.
RANGE_ROWS = 1 << 17
# monotonically_increasing_id: the partition number above 33 bits of the row's place in it.
_ROW_BITS = 33


def ordered_ranges(df: DataFrame, group: list[str], order: list[Column | str], rows: int = RANGE_ROWS, label: str = "ordered") -> tuple[DataFrame, DataFrame]:
    """``df`` in ranges, and what the ranges hold.

    The first table is ``df`` (read three times, so pass a stored table) with
    ``_range`` and ``_at``, which ascends through the whole order. The second
    has one row per range and group in it: ``_low`` (its least ``_at``),
    ``_size`` (rows), ``_before`` (rows of the group in earlier ranges) and
    ``_total`` (rows of the group).
    """
    spark = df.sparkSession
    keys = [F.col(g) for g in group] + [F.col(c) if isinstance(c, str) else c for c in order]
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows))
    ordered = stored(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
                     .withColumn("_range", F.shiftright("_at", _ROW_BITS).cast("int")), label)
    sizes = ordered.groupBy(*group, "_range").agg(F.min("_at").alias("_low"), F.count(F.lit(1)).alias("_size"))
    w = W.partitionBy(*group)
    ranges = sizes.select("*", F.coalesce(F.sum("_size").over(w.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                          F.sum("_size").over(w).alias("_total"))
    return ordered, ranges


def _same(group: list[str]) -> Column:
    return F.expr(" AND ".join(f"a.{c} <=> b.{c}" for c in [*group, "_range"]))


def positions(df: DataFrame, group: list[str], order: list[Column | str], name: str = "position", total: str | None = None) -> DataFrame:
    """``df`` with the number of rows of its group that come before each row
    (``name``, from 0) and, on request, the rows of the group (``total``)."""
    ordered, ranges = ordered_ranges(df, group, order)
    j = ordered.alias("a").join(ranges.alias("b"), _same(group))
    more = [F.col("b._total").alias(total)] if total else []
    return j.select(*[F.col(f"a.{c}") for c in df.columns], (F.col("a._at") - F.col("b._low") + F.col("b._before")).alias(name), *more)


def running_sums(df: DataFrame, group: list[str], order: list[Column | str], value: str, name: str = "before", total: str | None = None) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows of its group that come
    before each row (``name``) and, on request, over the whole group (``total``)."""
    ordered, _ = ordered_ranges(df, group, order)
    w = W.partitionBy(*group)
    sums = ordered.groupBy(*group, "_range").agg(F.sum(value).alias("_sum"))
    sums = sums.select("*", F.sum("_sum").over(w.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)).alias("_earlier"), F.sum("_sum").over(w).alias("_all"))
    inside = F.sum(value).over(W.partitionBy(*group, "_range").orderBy("_at").rowsBetween(W.unboundedPreceding, -1))
    j = ordered.withColumn("_inside", inside).alias("a").join(sums.alias("b"), _same(group))
    zero = F.lit(0)
    more = [F.coalesce("b._all", zero).alias(total)] if total else []
    return j.select(*[F.col(f"a.{c}") for c in df.columns], (F.coalesce("b._earlier", zero) + F.coalesce("a._inside", zero)).alias(name), *more)
