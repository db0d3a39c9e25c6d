"""Weekly KPI sections (main metrics, channel sections, funnel ratios,
headcount, productivity, headcount targets).

Each section merges several weekly aggregates. Instead of a chain of FULL
OUTER joins on a COALESCEd week (one shuffle per join, expression keys),
every component is aggregated to (q, week) and the components are stacked
with ``unionByName`` and merged by one ``groupBy(q, week)``: a single
shuffle whatever the number of components. Each component has at most one
row per (q, week), so ``max`` picks its value and keeps its NULLs.

All weeks with LAG are partitioned by quarter (and dims), never a global
single-partition window.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from tallyspark.functions.counting import distinct_counts
from tallyspark.functions.exprs import SENIOR, aging_key, norm_key, safe_div
from tallyspark.operators.calendar import in_quarter

# Funnel types counted over CREATED, and the section columns they feed.
FUNNEL_RATIOS = [
    ("PERFECT STORE", "perfect_stores", "pct_perfect_stores"),
    ("HANDOFF_3", "handoff_3", "pct_handoff_3d"),
    ("HANDOFF_7", "handoff_7", "pct_handoff_7d"),
    ("LOG_7", "log_7", "pct_login_7d"),
    ("HANDOFF_28", "handoff_28", "pct_handoff_28d"),
    ("LOG_28", "log_28", "pct_login_28d"),
    ("ORDER_28", "order_28", "pct_first_order"),
]
AVG_DAYS = [("AVG_DIAS_HANDOFF", "avg_dias_handoff"), ("AVG_DIAS_LOG", "avg_dias_log"),
            ("AVG_DIAS_ORDER", "avg_dias_order")]
SENIOR_TARGET_KEY = "03 - SENIOR"


def _sum_type(t: str):
    return F.sum(F.when(F.col("type") == t, F.col("metric")).otherwise(F.lit(0.0)))


def _avg_type(t: str):
    return F.avg(F.when(F.col("type") == t, F.col("metric")))


def merge_weekly(parts: list[DataFrame], keys: tuple[str, ...] = ("q", "week")) -> DataFrame:
    """Stack per-week components and merge them with one aggregation."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    cols = [c for c in dict.fromkeys(c for p in parts for c in p.columns) if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(F.col(f"`{c}`")).alias(c) for c in cols])


# ---------------------------------------------------------------- main metrics
def main_metrics_top(elc: DataFrame, quarter: str | None = None) -> DataFrame:
    """Stocks (TOTAL AVAILABLE/ACTIVE), activation rate and net adds."""
    f = in_quarter(elc, quarter).where(F.col("type").isin("TOTAL AVAILABLE", "TOTAL ACTIVE", "AVAILABLE", "ACTIVE"))
    s = f.groupBy("q", "week").agg(_sum_type("TOTAL AVAILABLE").alias("total_available_stores"),
                                   _sum_type("TOTAL ACTIVE").alias("total_active_stores"),
                                   _sum_type("AVAILABLE").alias("new_available"),
                                   _sum_type("ACTIVE").alias("new_active"))
    w = W.partitionBy("q").orderBy("week")
    return s.select("q", "week", "total_available_stores", "total_active_stores",
                    safe_div("new_active", "new_available").alias("activation_rate_pct"),
                    (F.col("total_available_stores") - F.lag("total_available_stores").over(w)).alias("net_available_adds"),
                    (F.col("total_active_stores") - F.lag("total_active_stores").over(w)).alias("net_active_adds"),
                    "new_available", "new_active")


def net_adds(elc: DataFrame, dims: tuple[str, ...] = ("country",), quarter: str | None = None) -> DataFrame:
    """Net adds of the stocks per quarter and dimensions (LAG partitioned by
    quarter and dims)."""
    f = in_quarter(elc, quarter).where(F.col("type").isin("TOTAL AVAILABLE", "TOTAL ACTIVE"))
    s = f.groupBy("q", *dims, "week").agg(_sum_type("TOTAL AVAILABLE").alias("total_available_stores"),
                                          _sum_type("TOTAL ACTIVE").alias("total_active_stores"))
    w = W.partitionBy("q", *dims).orderBy("week")
    return s.select("q", *dims, "week", "total_available_stores", "total_active_stores",
                    (F.col("total_available_stores") - F.lag("total_available_stores").over(w)).alias("net_available_adds"),
                    (F.col("total_active_stores") - F.lag("total_active_stores").over(w)).alias("net_active_adds"))


def main_metrics_bottom(elc: DataFrame, quarter: str | None = None) -> DataFrame:
    f = in_quarter(elc, quarter).where(F.col("type").isin("AVAILABLE", "ACTIVE"))
    s = f.groupBy("q", "week").agg(_sum_type("AVAILABLE").alias("new_available_stores"),
                                   _sum_type("ACTIVE").alias("new_active_stores"))
    return s.withColumn("new_inflow_active_rate_pct", safe_div("new_active_stores", "new_available_stores"))


# ------------------------------------------------------------ section parts
def elc_channel_weekly(elc: DataFrame, team: str, channel_group: str, quarter: str | None = None,
                       types: list[str] | None = None) -> DataFrame:
    """Per week of one channel: new available, created, funnel counts and
    average days (counts SUM with absent = 0, averages AVG with absent = NULL)."""
    f = in_quarter(elc, quarter).where((F.col("team") == team) & (F.col("channel_group") == channel_group))
    if types is not None:
        f = f.where(F.col("type").isin(*types))
    aggs = [_sum_type("AVAILABLE").alias("new_available"), _sum_type("CREATED").alias("store_created")]
    aggs += [_sum_type(t).alias(c) for t, c, _ in FUNNEL_RATIOS]
    aggs += [_avg_type(t).alias(c) for t, c in AVG_DAYS]
    return f.groupBy("q", "week").agg(*aggs)


def elc_target_weekly(target: DataFrame, team: str, channel_group: str, kind: str = "AVAILABLE",
                      quarter: str | None = None) -> DataFrame:
    t = in_quarter(target, quarter).where((F.col("team") == team) & (F.col("channel_group") == channel_group)
                                          & (F.col("tipo_target") == kind))
    return t.groupBy("q", "week").agg(F.sum("target").alias("target_new_available"))


def rep_heads(funnel: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ``one``, ``one_senior``): the distinct active reps and those of them
    active as a senior. A NULL rep id is no rep."""
    senior = F.col("aging_category_final").eqNullSafe(SENIOR)
    return distinct_counts(funnel.where(F.col("hc") == 1), keys, "hunter_email", "one", senior, "one_senior")


def headcount_weekly(funnel: DataFrame, quarter: str | None = None, project: str | None = None,
                     project_col: str = "proyecto") -> DataFrame:
    """Per week: distinct active reps (HC = 1), active seniors, % old, and
    productivity = SUM(stores) / SUM(days) over every HC value. A NULL rep
    id is no rep, but its stores and days count.

    Stores and days are summed per week; the distinct reps join these sums
    as rows of their own."""
    f = in_quarter(funnel, quarter)
    if project is not None:
        f = f.where(F.col(project_col) == project)
    f = f.withColumnRenamed("week_date", "week")
    sums = f.groupBy("q", "week").agg(F.sum("stores_totales").alias("stores"), F.sum("dias_trabajados").alias("dias")).withColumn("one", F.lit(0))
    wk = sums.unionByName(rep_heads(f, ["q", "week"]), allowMissingColumns=True).groupBy("q", "week").agg(
        F.sum("one").cast("bigint").alias("headcount"), F.coalesce(F.sum("one_senior"), F.lit(0)).cast("bigint").alias("senior_headcount"),
        F.sum("stores").alias("stores_real"), F.sum("dias").alias("dias_real"))
    return wk.select("q", "week", "headcount", "senior_headcount",
                     safe_div("senior_headcount", "headcount").alias("pct_old"),
                     "stores_real", "dias_real", safe_div("stores_real", "dias_real").alias("productivity"))


def productivity_weekly(funnel: DataFrame, quarter: str | None = None) -> DataFrame:
    """SUM(stores) / SUM(days) per week, every HC value (ratio of sums)."""
    f = in_quarter(funnel, quarter)
    s = f.groupBy("q", F.col("week_date").alias("week")).agg(
        F.sum("stores_totales").alias("stores_real"), F.sum("dias_trabajados").alias("dias_real"))
    return s.withColumn("productivity", safe_div("stores_real", "dias_real"))


def hc_target_weekly(target: DataFrame, quarter: str | None = None, project: str | None = None,
                     project_col: str = "proyecto") -> DataFrame:
    """HC target per week and its senior share (aging compared normalized)."""
    t = in_quarter(target, quarter)
    if project is not None:
        t = t.where(F.col(project_col) == project)
    is_hc = F.col("tipo_target") == "HC"
    s = t.groupBy("q", "week").agg(
        F.sum(F.when(is_hc, F.col("target")).otherwise(F.lit(0.0))).alias("target_headcount"),
        F.sum(F.when(is_hc & (norm_key("aging") == SENIOR_TARGET_KEY), F.col("target"))
              .otherwise(F.lit(0.0))).alias("target_senior_headcount"))
    return s.withColumn("pct_target_old", safe_div("target_senior_headcount", "target_headcount"))


def funnel_ratios(elc: DataFrame, quarter: str | None = None) -> DataFrame:
    """Funnel ratios over CREATED per week and channel."""
    f = in_quarter(elc, quarter)
    s = f.groupBy("q", "week", "team", "channel_group").agg(
        _sum_type("CREATED").alias("store_created"), *[_sum_type(t).alias(c) for t, c, _ in FUNNEL_RATIOS])
    return s.select("q", "week", "team", "channel_group", "store_created",
                    *[safe_div(c, "store_created").alias(p) for _, c, p in FUNNEL_RATIOS])


# ---------------------------------------------------------- channel sections
def rep_cells(funnel: DataFrame, target: DataFrame, quarter: str | None = None, project: str | None = None,
              by_project: bool = False, project_col: str = "proyecto") -> DataFrame:
    """The reps' figures and targets per week (and project), country and aging:
    stores and days (``seen``: the funnel has rows of the cell), target
    headcounts, and the target stores with the days behind them. Both sides
    are summed to the cell before they are shuffled."""
    proj = [project_col] if by_project else []
    f, t = in_quarter(funnel, quarter), in_quarter(target, quarter)
    if project is not None:
        f, t = f.where(F.col(project_col) == project), t.where(F.col(project_col) == project)
    cells = f.groupBy("q", F.col("week_date").alias("week"), *proj, "country", aging_key("aging_category_final").alias("aging")).agg(
        F.sum("stores_totales").alias("stores"), F.sum("dias_trabajados").alias("dias"),
        F.sum(F.when(F.col("hc") == 1, F.col("dias_trabajados"))).alias("days"), F.max(F.lit(True)).alias("seen"))
    is_hc, is_rate = F.col("tipo_target") == "HC", F.col("tipo_target") == "PRODUCTIVIDAD"
    zero = F.lit(0.0)
    goals = t.groupBy("q", "week", *proj, "country", norm_key("aging").alias("aging")).agg(
        F.max(is_rate).alias("rated"), F.avg(F.when(is_rate, F.col("target"))).alias("rate"),
        F.sum(F.when(is_hc, F.col("target")).otherwise(zero)).alias("hc"),
        F.sum(F.when(is_hc & (norm_key("aging") == SENIOR_TARGET_KEY), F.col("target")).otherwise(zero)).alias("hc_senior"))
    m = merge_weekly([cells, goals], ("q", "week", *proj, "country", "aging"))
    meets = F.col("rated") & F.col("days").isNotNull() & F.col("country").isNotNull() & F.col("aging").isNotNull()
    return m.select("*", F.when(meets, F.col("rate") * F.col("days")).alias("target_stores"), F.when(meets, F.col("days")).alias("target_days"))


def rep_weekly(funnel: DataFrame, target: DataFrame, quarter: str | None = None, project: str | None = None,
               by_project: bool = False, project_col: str = "proyecto") -> DataFrame:
    """Everything a section takes from the reps, per week (and project): the
    cells summed, and the distinct reps, which join them as rows of their own."""
    proj = [project_col] if by_project else []
    f = in_quarter(funnel, quarter)
    if project is not None:
        f = f.where(F.col(project_col) == project)
    none = F.when(F.col("seen"), F.lit(0))
    cells = rep_cells(funnel, target, quarter, project, by_project, project_col).select("*", none.alias("one"), none.alias("one_senior"))
    rows = cells.unionByName(rep_heads(f.withColumnRenamed("week_date", "week"), ["q", "week", *proj]), allowMissingColumns=True)
    return rows.groupBy("q", "week", *proj).agg(
        F.sum("one").alias("headcount"), F.sum("one_senior").alias("senior_headcount"),
        F.sum("stores").alias("stores_real"), F.sum("dias").alias("dias_real"),
        F.sum("hc").alias("target_headcount"), F.sum("hc_senior").alias("target_senior_headcount"),
        F.sum("target_stores").alias("target_store_created"), F.sum("target_days").alias("dias_trabajados_reales_total"))


def rep_channel_section(elc: DataFrame, elc_tg: DataFrame, reps: DataFrame, team: str, channel_group: str,
                        quarter: str | None = None) -> DataFrame:
    """A rep-based channel section (Hunting, IS Outbound, IS Inbound): 20
    weekly KPIs plus the numerator/denominator parts the QTD rules need.
    ``reps`` is ``rep_weekly`` of its reps."""
    m = merge_weekly([elc_channel_weekly(elc, team, channel_group, quarter),
                      elc_target_weekly(elc_tg, team, channel_group, "AVAILABLE", quarter), reps])
    created = F.col("store_created")
    return m.select(
        "q", "week", "new_available", "target_new_available", "store_created", "target_store_created",
        safe_div("stores_real", "dias_real").alias("productivity"),
        safe_div("target_store_created", "dias_trabajados_reales_total").alias("target_productivity"),
        "headcount", "target_headcount", safe_div("senior_headcount", "headcount").alias("pct_old"),
        safe_div("target_senior_headcount", "target_headcount").alias("pct_target_old"),
        *[safe_div(c, created).alias(p) for _, c, p in FUNNEL_RATIOS],
        *[c for _, c in AVG_DAYS],
        # parts behind the ratios
        "stores_real", "dias_real", "dias_trabajados_reales_total", "senior_headcount",
        "target_senior_headcount", *[c for _, c, _ in FUNNEL_RATIOS])


def in_week_order(section: DataFrame) -> DataFrame:
    """A weekly section in the order of its weeks, each with its place in the
    quarter (a window over the weeks of one quarter)."""
    place = F.row_number().over(W.partitionBy("q").orderBy("week")).cast("bigint")
    return section.withColumn("week_rank", place).orderBy("q", "week_rank")


def by_channel(elc: DataFrame, elc_tg: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The weekly funnel and its targets reduced to one row per week, channel
    and type: what all sections of a report read instead of the whole tables.
    Counts are summed, AVG_ types averaged, as the sections would."""
    metric = F.when(F.col("type").startswith("AVG_"), F.avg("metric")).otherwise(F.sum("metric"))
    keys = ("q", "week", "team", "channel_group")
    return (elc.groupBy(*keys, "type").agg(metric.alias("metric")),
            elc_tg.groupBy(*keys, "tipo_target").agg(F.sum("target").alias("target")))


def simple_channel_section(elc: DataFrame, elc_tg: DataFrame, team: str, channel_group: str,
                           with_created: bool, quarter: str | None = None) -> DataFrame:
    """Self-onboarding / brand expansion: new available vs target (+ created)."""
    types = ["AVAILABLE", "CREATED"] if with_created else ["AVAILABLE"]
    a = elc_channel_weekly(elc, team, channel_group, quarter, types=types)
    a = a.select("q", "week", "new_available", *(["store_created"] if with_created else []))
    t = elc_target_weekly(elc_tg, team, channel_group, "AVAILABLE", quarter)
    m = merge_weekly([a, t])
    return m.select("q", "week", "new_available", "target_new_available",
                    *(["store_created"] if with_created else []))


def gap_concentration(elc: DataFrame, elc_tg: DataFrame, dims: tuple[str, ...] = ("country",),
                      quarter: str | None = None) -> DataFrame:
    """Where a channel's new-available gap sits: actual vs target per
    (q, channel_group, dims), the target counted only over the weeks the
    channel has actuals, and each part's share of the channel's total gap
    (a window over the few countries of one channel and quarter)."""
    a = (in_quarter(elc, quarter).where(F.col("type") == "AVAILABLE"))
    weeks = a.select("q", "channel_group", "week").distinct()
    t = (in_quarter(elc_tg, quarter).where(F.col("tipo_target") == "AVAILABLE")
         .join(weeks, ["q", "channel_group", "week"], "left_semi")
         .groupBy("q", "channel_group", *dims).agg(F.sum("target").alias("target")))
    a = a.groupBy("q", "channel_group", *dims).agg(F.sum("metric").alias("actual"))
    j = a.join(t, ["q", "channel_group", *dims], "full_outer")
    gap = F.coalesce("actual", F.lit(0.0)) - F.coalesce("target", F.lit(0.0))
    w = W.partitionBy("q", "channel_group")
    return j.select("q", "channel_group", *dims, F.coalesce("actual", F.lit(0.0)).alias("actual"),
                    F.coalesce("target", F.lit(0.0)).alias("target"), gap.alias("gap"),
                    safe_div(gap, F.sum(gap).over(w)).alias("share"))


def gap_cube(parts: DataFrame, dims: tuple[str, ...] = ("channel", "country", "aging")) -> DataFrame:
    """Where a gap sits, over every combination of ``dims`` at once: actual,
    target and gap of each cell of the CUBE, its share of the gaps of its
    grouping, and its rank there (the most negative first, ties by the dims).

    ``parts``: q, dims, actual, target. ``grain`` names the dims a row keeps
    ("total": none); a NULL in one of them is a value, in another it is summed
    away. The windows run over one grouping of one quarter, whose rows are
    combinations of the dims."""
    sets = [c for n in range(len(dims) + 1) for c in combinations(dims, n)]
    g = parts.groupingSets([["q", *c] for c in sets], "q", *dims).agg(
        F.coalesce(F.sum("actual").cast("double"), F.lit(0.0)).alias("actual"),
        F.coalesce(F.sum("target").cast("double"), F.lit(0.0)).alias("target"), F.grouping_id().alias("gid"))
    name = {sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in c): "+".join(c) or "total" for c in sets}
    g = g.withColumn("grain", F.coalesce(*[F.when(F.col("gid") == k, F.lit(v)) for k, v in name.items()]))
    g = g.withColumn("gap", F.col("actual") - F.col("target"))
    w = W.partitionBy("q", "grain")
    order = w.orderBy("gap", *[F.col(d).asc_nulls_last() for d in dims])
    return g.select("q", "grain", *dims, "actual", "target", "gap", safe_div("gap", F.sum("gap").over(w)).alias("share"),
                    F.row_number().over(order).cast("bigint").alias("rank"))


def rep_gap_parts(ht_funnel: DataFrame, ht_target: DataFrame, is_funnel: DataFrame, is_target: DataFrame,
                  quarter: str | None = None) -> DataFrame:
    """Real and target stores of the rep channels per (q, channel, country,
    aging), from the rep funnels, which know the aging of a rep; cells in
    which nobody worked have no part."""
    cols = ["q", "channel", "country", "aging", F.col("stores").alias("actual"), F.col("target_stores").alias("target")]
    hunting = rep_cells(ht_funnel, ht_target, quarter).withColumn("channel", F.lit("HUNTING"))
    inside = rep_cells(is_funnel, is_target, quarter, by_project=True).withColumn("channel", F.concat(F.lit("INSIDE SALES "), "proyecto"))
    return hunting.select(*cols).unionByName(inside.select(*cols)).where(F.col("actual").isNotNull())
