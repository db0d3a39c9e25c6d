"""Early churn vs target.

Channel rows and the TOTAL row come from one GROUPING SETS aggregation
(one scan, one shuffle) instead of a UNION of two aggregates. Weeks are the
closed weeks of each quarter's declared axis; the axis has one row per
calendar week, so it is broadcast (its size is bounded by the calendar, not
by the data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.exprs import CHANNEL_ORDER, channel_rank, churn_channel, round_half_away, safe_div
from tallyspark.operators.calendar import closed_weeks

AGES = ["M1", "M2", "M3"]
# Fixed: anomaly threshold in percentage points.
ANOMALY_PP = 40.0


def churn_targets_long(target: DataFrame, country: str = "TOTAL") -> DataFrame:
    """Wide churn targets -> (week, canal, age, target_pct), one row each (a
    repeated target row counts as one, their mean); only the requested
    country rows (the targets are stated for TOTAL)."""
    t = target.where(F.col("country") == country)
    stacked = F.expr("stack(3, 'M1', `TARGET_%CHURN_M1`, 'M2', `TARGET_%CHURN_M2`, "
                     "'M3', `TARGET_%CHURN_M3`) AS (age, target_pct)")
    long = t.select(F.col("week").cast("date").alias("week"), F.col("channel_am").alias("canal"), stacked)
    return long.groupBy("week", "canal", "age").agg(F.avg("target_pct").alias("target_pct"))


def early_churn(detail: DataFrame, target: DataFrame, axis: DataFrame, as_of: str,
                tz: str = "America/Bogota", mapped_only: bool = False,
                threshold: float = ANOMALY_PP, exclude_country: str = "BR") -> DataFrame:
    """Per (q, week, age, channel|TOTAL): churn vs target with the anomaly flag.

    ``country != 'BR'`` also drops NULL countries (three-valued logic, as
    the rule is written). TOTAL includes unmapped channels unless
    ``mapped_only``. The churn % is rounded to one decimal before the delta,
    as the business query does; ``churn_ratio`` keeps the exact ratio.
    """
    weeks = closed_weeks(axis, as_of, tz).select("q", "week")
    s = (detail.where(F.col("country") != exclude_country)
         .join(weeks, "week")
         .select("q", "week", "age", churn_channel("channel_am").alias("canal"), "churn", "total_store"))
    if mapped_only:
        s = s.where(F.col("canal").isNotNull())
    g = (s.groupingSets([["q", "week", "age", "canal"], ["q", "week", "age"]], "q", "week", "age", "canal")
         .agg(F.sum("churn").alias("churn_stores"), F.sum("total_store").alias("total_stores"),
              F.grouping_id().alias("gid")))
    g = (g.where((F.col("gid") != 0) | F.col("canal").isNotNull())
         .withColumn("canal", F.when(F.col("gid") == 0, F.col("canal")).otherwise(F.lit("TOTAL"))))
    pct = round_half_away(safe_div("churn_stores", "total_stores") * 100, 1) / 100
    g = g.select("q", "week", "age", "canal", "churn_stores", "total_stores", pct.alias("churn_pct"),
                 safe_div("churn_stores", "total_stores").alias("churn_ratio"))
    t = churn_targets_long(target)
    j = g.join(t, ["week", "canal", "age"], "left")
    delta = round_half_away((F.col("churn_pct") - F.col("target_pct")) * 100, 1)
    return j.select("q", "week", "age", "canal", "churn_stores", "total_stores", "churn_pct", "target_pct",
                    delta.alias("delta_pp"), (F.abs(delta) > threshold).alias("is_anomaly"), "churn_ratio",
                    channel_rank("canal").alias("canal_rank"))


def churn_qtd(churn: DataFrame) -> DataFrame:
    """Quarter-to-date churn per (q, age, channel): ratio of sums; target
    weighted by stores over the weeks that have a target."""
    has_t = F.col("target_pct").isNotNull()
    g = churn.groupBy("q", "age", "canal").agg(
        F.sum("churn_stores").alias("churn_stores"), F.sum("total_stores").alias("total_stores"),
        F.sum(F.when(has_t, F.col("target_pct") * F.col("total_stores"))).alias("_tw"),
        F.sum(F.when(has_t, F.col("total_stores"))).alias("_tden"),
        F.count(F.lit(1)).alias("weeks"), F.count("target_pct").alias("weeks_with_target"))
    qtd = safe_div("churn_stores", "total_stores")
    tq = safe_div("_tw", "_tden")
    return g.select("q", "age", "canal", "churn_stores", "total_stores", qtd.alias("churn_qtd"),
                    tq.alias("target_qtd"), (qtd - tq).alias("gap_qtd"), "weeks", "weeks_with_target")


def churn_anomalies(churn: DataFrame) -> DataFrame:
    return churn.where(F.col("is_anomaly"))


def churn_completeness(churn: DataFrame) -> DataFrame:
    """Missing (q, week, age, channel) cells: every week present must have
    the five channels for each of the three ages."""
    grid = (churn.select("q", "week").distinct()
            .select("q", "week", F.explode(F.array(*[F.lit(a) for a in AGES])).alias("age"))
            .select("q", "week", "age", F.explode(F.array(*[F.lit(c) for c in CHANNEL_ORDER])).alias("canal")))
    return grid.join(churn.select("q", "week", "age", "canal"), ["q", "week", "age", "canal"], "left_anti")
