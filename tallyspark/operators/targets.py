"""Targets: per-kind aggregation of long targets, individual and macro
targets recomputed from productivity targets, reconciliation and the grain
(fan-out) check.

Rules kept from the business definitions:

* target aggregates depend on the kind: STORES is a flow (SUM), HC a stock
  (AVG), PRODUCTIVIDAD a rate (AVG);
* an individual target is productivity target x the rep's real days, never
  a group target divided by headcount;
* the macro target productivity is the sum of individual targets over the
  sum of days (a ratio of sums, never an average of ratios).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.exprs import aging_key, norm_key, safe_div
from tallyspark.operators.calendar import in_quarter


def target_by_kind(target: DataFrame, keys: list[str], quarter: str | None = None,
                   aging_col: str | None = "aging", week_col: str = "week") -> DataFrame:
    """Long targets -> one wide row per cell (one aggregation, no self-join).

    ``stores_tg`` = SUM(STORES) (absent -> 0), ``hc_tg`` = AVG(HC) and
    ``prod_tg`` = AVG(PRODUCTIVIDAD) (absent -> NULL). Duplicate rows do not
    change the averages.
    """
    t = in_quarter(target, quarter)
    kind, val = F.col("tipo_target"), F.col("target")
    if week_col != "week":
        t = t.withColumnRenamed(week_col, "week")
    if aging_col:
        # Grouping columns are named (not expressions) and ordered like the
        # join keys downstream, so the aggregation's hash partitioning is
        # reused by the join instead of a second exchange.
        t = t.withColumn("aging_norm", norm_key(aging_col))
    group = ["q"] + [k for k in keys if k != "aging_norm"]
    if aging_col:
        group.insert(min(2, len(group)), "aging_norm")
    return t.groupBy(*group).agg(
        F.sum(F.when(kind == "STORES", val).otherwise(F.lit(0.0))).alias("stores_tg"),
        F.avg(F.when(kind == "HC", val)).alias("hc_tg"),
        F.avg(F.when(kind == "PRODUCTIVIDAD", val)).alias("prod_tg"))


def hunter_days(funnel: DataFrame, quarter: str | None = None, project: str | None = None,
                project_col: str = "proyecto", active_only: bool = True) -> DataFrame:
    """Rep x week x country x aging (x project) real days; active reps
    (HC = 1) and mapped aging only."""
    f = in_quarter(funnel, quarter)
    if active_only:
        f = f.where(F.col("hc") == 1)
    keys = ["q", F.col("week_date").alias("week"), "country"]
    if project is not None:
        f = f.where(F.col(project_col) == project)
        keys.append(F.col(project_col).alias("proyecto"))
    return (f.groupBy(*keys, aging_key("aging_category_final").alias("aging_norm"), "hunter_email")
            .agg(F.sum("dias_trabajados").alias("dias_trabajados_reales"))
            .where(F.col("aging_norm").isNotNull()))


def _prod_target(target: DataFrame, quarter, project, project_col="proyecto"):
    t = in_quarter(target, quarter).where(F.col("tipo_target") == "PRODUCTIVIDAD")
    keys = ["q", "week", "country"]
    if project is not None:
        t = t.where(F.col(project_col) == project)
        keys.append(project_col)
    return (t.groupBy(*keys, norm_key("aging").alias("aging_norm"))
            .agg(F.avg("target").alias("productividad_target")))


def hunter_target_stores(funnel: DataFrame, target: DataFrame, quarter: str | None = None,
                         project: str | None = None) -> DataFrame:
    """Individual target per rep-week: productivity target of the rep's cell
    times the rep's real days (inner join on the full grain)."""
    d = hunter_days(funnel, quarter, project)
    t = _prod_target(target, quarter, project)
    keys = ["q", "week", "country", "aging_norm"] + (["proyecto"] if project is not None else [])
    return (d.join(t, keys)
            .withColumn("target_stores", F.col("productividad_target") * F.col("dias_trabajados_reales")))


def macro_target_weekly(funnel: DataFrame, target: DataFrame, quarter: str | None = None,
                        project: str | None = None) -> DataFrame:
    """Per week: sum of individual targets, days behind them and the macro
    target productivity (a ratio of sums)."""
    ind = hunter_target_stores(funnel, target, quarter, project)
    return (ind.groupBy("q", "week")
            .agg(F.sum("target_stores").alias("target_store_created"),
                 F.sum("dias_trabajados_reales").alias("dias_trabajados_reales_total"))
            .withColumn("target_productivity",
                        safe_div("target_store_created", "dias_trabajados_reales_total")))


def target_reconciliation(funnel: DataFrame, target: DataFrame, quarter: str | None = None,
                          project: str | None = None, project_col: str = "proyecto") -> DataFrame:
    """Sum of individual targets vs the group STORES target, per week."""
    ind = (hunter_target_stores(funnel, target, quarter, project)
           .groupBy("q", "week").agg(F.sum("target_stores").alias("individual_target")))
    t = in_quarter(target, quarter).where(F.col("tipo_target") == "STORES")
    if project is not None:
        t = t.where(F.col(project_col) == project)
    grp = t.groupBy("q", "week").agg(F.sum("target").alias("group_target"))
    out = ind.join(grp, ["q", "week"], "full_outer")
    return out.select("q", "week", "individual_target", "group_target",
                      (F.col("individual_target") - F.col("group_target")).alias("diff"),
                      safe_div(F.col("individual_target") - F.col("group_target"),
                               F.col("group_target")).alias("diff_pct"))


def target_grain_check(target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the declared target grain that appear more than once (the
    fan-out guard before any target join)."""
    return (target.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def grain_report(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """``target_grain_check`` of every table under its declared grain, in one
    result: (table, the union of all grains' columns as text, n_rows); columns
    that a table's grain does not have are NULL."""
    cols = list(dict.fromkeys(k for _, keys in tables.values() for k in keys))
    parts = [target_grain_check(t, keys).select(
        F.lit(name).alias("table"), *[(F.col(c) if c in keys else F.lit(None)).cast("string").alias(c) for c in cols], "n_rows")
        for name, (t, keys) in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
