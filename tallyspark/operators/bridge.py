"""Variance bridges target -> actual.

IS bridge: six sequential effects (productivity, headcount, maturity per
project), computed from a FULL OUTER join of real and target cells.
HT bridge: "worlds" S0..S3 over the target universe with the real values
substituted one driver at a time.

Both are expressed as two-level aggregations (cell, then quarter/project);
every quarter is computed at once with ``q`` as a key, so nothing runs in
one task unless the data has one quarter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.counting import distinct_counts
from tallyspark.functions.exprs import (AGING_LABELS, aging_key, guarded_div, norm_key,
                                        round_half_away, safe_div)
from tallyspark.operators.calendar import in_quarter, valid_weeks
from tallyspark.operators.targets import target_by_kind

# Short labels and display order of the IS projects that have
# one (any other project follows under its own name), and the effect labels.
IS_PROJECTS = [("OUTBOUND", "OB"), ("INBOUND", "IB")]
IS_EFFECTS = [("ef_prod", "Productividad"), ("ef_hc", "Headcount"), ("ef_maturity", "Maturity")]


def _headcount_cells(funnel: DataFrame, keys: list[str]) -> DataFrame:
    """Sums and distinct active reps per cell. Days and stores are summed
    to the cell before they are shuffled; the distinct reps join these sums as
    rows of their own. A NULL rep id is no rep; its days and stores stay in the sums."""
    hc1 = F.col("hc") == 1
    sums = funnel.groupBy(*keys).agg(F.sum("dias_trabajados").alias("dias"),
                                     F.sum(F.when(hc1, F.col("dias_trabajados")).otherwise(F.lit(0))).alias("dias_active"),
                                     F.sum("stores_totales").alias("stores")).withColumn("one", F.lit(0))
    heads = distinct_counts(funnel.where(hc1), keys, "hunter_email", "one")
    return sums.unionByName(heads, allowMissingColumns=True).groupBy(*keys).agg(
        F.sum("one").cast("bigint").alias("hc_real"), F.sum("dias").alias("dias_real"),
        F.sum("dias_active").alias("dias_active"), F.sum("stores").alias("stores_real"))


def is_real_cells(funnel: DataFrame, quarter: str | None = None, project_col: str = "proyecto_agrupado") -> DataFrame:
    """The IS funnel reduced to (q, proyecto, aging_norm, country, week_date):
    what every IS bridge and mode takes from it. The bridge operators accept
    it in place of the funnel, so one reduced table can serve them all."""
    f = in_quarter(funnel, quarter).select(
        "q", F.col(project_col).alias("proyecto"), aging_key("aging_category_final").alias("aging_norm"),
        "country", "week_date", "hunter_email", "hc", "dias_trabajados", "stores_totales")
    return _headcount_cells(f, ["q", "proyecto", "aging_norm", "country", "week_date"])


def ht_real_cells(funnel: DataFrame, quarter: str | None = None) -> DataFrame:
    """The HT funnel reduced to (q, week_date, aging_category_final, country), as ``is_real_cells``."""
    return _headcount_cells(in_quarter(funnel, quarter), ["q", "week_date", "aging_category_final", "country"])


def _reduced(funnel: DataFrame, reduce, quarter: str | None, *more) -> DataFrame:
    return in_quarter(funnel, quarter) if "hc_real" in funnel.columns else reduce(funnel, quarter, *more)


# ------------------------------------------------------------------ IS bridge
def _in_weeks(df: DataFrame, weeks: DataFrame, mode: str, exclude: DataFrame | None) -> DataFrame:
    """Funnel rows of the valid weeks. In QTD mode without exclusions these
    are all rows, so nothing is joined."""
    if mode == "QTD" and exclude is None:
        return df
    return df.join(weeks.select("q", "week").distinct(), ["q", "week"], "left_semi")


def bridge_is_target_check(target: DataFrame, funnel: DataFrame, mode: str = "QTD",
                           quarter: str | None = None) -> DataFrame:
    """STORES target by project x week over the valid weeks (the bridge's
    target total must equal this direct sum)."""
    weeks = valid_weeks(funnel, mode, quarter)
    t = in_quarter(target, quarter).where(F.col("tipo_target") == "STORES")
    return (t.join(weeks, ["q", "week"], "left_semi")
            .groupBy("q", "proyecto", "week").agg(F.sum("target").alias("stores_tg")))


def bridge_is_cells(funnel: DataFrame, target: DataFrame, mode: str = "QTD", quarter: str | None = None,
                    project_col: str = "proyecto_agrupado", exclude: DataFrame | None = None) -> DataFrame:
    """Real and target cells (project x aging x country x week) merged by a
    FULL OUTER join: target-only and real-only cells are both kept, and an
    unmapped (NULL) aging never matches."""
    cells = _reduced(funnel, is_real_cells, quarter, project_col)
    weeks = valid_weeks(cells, mode, exclude=exclude)
    real = _in_weeks(cells.withColumnRenamed("week_date", "week"), weeks, mode, exclude).drop("dias_active")
    t = in_quarter(target, quarter).join(weeks, ["q", "week"], "left_semi")
    tg = target_by_kind(t, ["proyecto", "country", "week"])
    r, g = real.alias("r"), tg.alias("t")
    keys = ["q", "proyecto", "aging_norm", "country", "week"]
    j = r.join(g, [F.col(f"r.{k}") == F.col(f"t.{k}") for k in keys], "full_outer")
    hc_tg, prod_tg = F.coalesce("t.hc_tg", F.lit(0.0)), F.coalesce("t.prod_tg", F.lit(0.0))
    return j.select(
        *[F.coalesce(F.col(f"r.{k}"), F.col(f"t.{k}")).alias(k) for k in keys],
        F.coalesce("r.hc_real", F.lit(0)).cast("bigint").alias("hc_real"),
        F.coalesce("r.dias_real", F.lit(0)).cast("bigint").alias("dias_real"),
        F.coalesce("r.stores_real", F.lit(0)).cast("bigint").alias("stores_real"),
        F.coalesce("t.stores_tg", F.lit(0.0)).alias("stores_tg"),
        hc_tg.alias("hc_tg"), prod_tg.alias("prod_tg"),
        guarded_div(F.col("t.stores_tg"), hc_tg * prod_tg).alias("dias_tg_por_agente"))


def bridge_is_project(cells: DataFrame) -> DataFrame:
    """Collapse cells to (q, project): sums plus target-day weighted and
    real-HC weighted productivity targets and attendance."""
    c = cells
    dias_tg_w = F.col("hc_tg") * F.col("dias_tg_por_agente")
    real_w = F.col("hc_real") * F.col("dias_tg_por_agente")
    bp = c.groupBy("q", "proyecto").agg(
        F.sum("stores_real").alias("stores_real"), F.sum("stores_tg").alias("stores_tg"),
        F.sum("dias_real").alias("dias_real"), F.sum("hc_real").alias("hc_real"),
        F.sum("hc_tg").alias("hc_tg"), F.sum(dias_tg_w).alias("dias_tg"),
        F.sum(F.col("prod_tg") * dias_tg_w).alias("_prod_tg_num"),
        F.sum(F.col("prod_tg") * real_w).alias("_mix_num"), F.sum(real_w).alias("_mix_den"))
    return bp.select(
        "q", "proyecto", "stores_real", "stores_tg", "dias_real", "hc_real", "hc_tg", "dias_tg",
        guarded_div("stores_real", "dias_real").alias("prod_real"),
        guarded_div("_prod_tg_num", "dias_tg").alias("prod_tg"),
        guarded_div("_mix_num", "_mix_den").alias("prod_tg_mix_real"),
        guarded_div("dias_real", "hc_real").alias("asist_real"),
        guarded_div("dias_tg", "hc_tg").alias("asist_tg"))


def bridge_is_effects(funnel: DataFrame, target: DataFrame, mode: str = "QTD", quarter: str | None = None,
                      project_col: str = "proyecto_agrupado", exclude: DataFrame | None = None) -> DataFrame:
    """``bridge_is_effects_of`` the cells of a funnel and its targets."""
    return bridge_is_effects_of(bridge_is_cells(funnel, target, mode, quarter, project_col, exclude))


def bridge_is_effects_of(cells: DataFrame) -> DataFrame:
    """Per (q, project), unrounded: real, target, gap and the three effects.

    Productivity and maturity are measured over the real days; headcount is
    what is left of the gap, so the bridge closes. Its parts ``hc_pure`` and
    ``attendance`` are given besides.
    """
    p = bridge_is_project(cells)
    hr, ht = F.col("hc_real"), F.col("hc_tg")
    ar, at = F.col("asist_real"), F.col("asist_tg")
    pr, pt, pm = F.col("prod_real"), F.col("prod_tg"), F.col("prod_tg_mix_real")
    out = p.select("q", "proyecto", F.col("stores_real").cast("double").alias("stores_real"), "stores_tg",
                   (F.col("stores_real") - F.col("stores_tg")).alias("desvio"),
                   (hr * ar * (pr - pm)).alias("ef_prod"), (hr * ar * (pm - pt)).alias("ef_maturity"),
                   ((hr - ht) * at * pt).alias("hc_pure"), (hr * (ar - at) * pt).alias("attendance"))
    return out.withColumn("ef_hc", F.col("desvio") - F.col("ef_prod") - F.col("ef_maturity"))


def bridge_is(funnel: DataFrame, target: DataFrame, mode: str = "QTD", quarter: str | None = None,
              project_col: str = "proyecto_agrupado", exclude: DataFrame | None = None) -> DataFrame:
    """``bridge_is_effects`` as displayed: every number rounded to a whole
    store. ``residual`` is the part of the headcount effect that neither
    headcount nor attendance explains."""
    e = bridge_is_effects(funnel, target, mode, quarter, project_col, exclude)
    names = ("stores_real", "stores_tg", "desvio", "ef_hc", "ef_maturity", "ef_prod", "hc_pure", "attendance")
    return e.select("q", "proyecto", *[round_half_away(c, 0).alias(c) for c in names],
                    round_half_away(F.col("ef_hc") - F.col("hc_pure") - F.col("attendance"), 0).alias("residual"))


def bridge_is_report(effects: DataFrame) -> DataFrame:
    """Long form of the effects of every project in the data:
    (q, seq, label, proyecto, delta), from ``bridge_is_effects``."""
    from pyspark.sql import Window as W
    known = F.lit(len(IS_PROJECTS))
    short = F.col("proyecto")
    for i, (proj, label) in reversed(list(enumerate(IS_PROJECTS))):
        known = F.when(F.col("proyecto") == proj, F.lit(i)).otherwise(known)
        short = F.when(F.col("proyecto") == proj, F.lit(label)).otherwise(short)
    n = len(IS_EFFECTS)
    # One row per project of a quarter.
    place = F.dense_rank().over(W.partitionBy("q").orderBy("known", "proyecto")) - 1
    p = effects.withColumn("known", known).withColumn("short", short).withColumn("place", place)
    return p.select("q", "proyecto", "place", "short", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(name).alias("name"), F.col(c).alias("delta")) for i, (c, name) in enumerate(IS_EFFECTS, start=1)])).alias("e")
    ).select("q", (F.col("place") * n + F.col("e.i")).cast("int").alias("seq"),
             F.concat("short", F.lit(" – "), "e.name").alias("label"), "proyecto", round_half_away("e.delta", 1).alias("delta"))


def bridge_is_totals(effects: DataFrame) -> DataFrame:
    """Quarter totals of the IS bridge from ``bridge_is_effects``: target,
    real, gap, gap %, sum of effects and the closure check, rounded last."""
    t = effects.groupBy("q").agg(
        F.sum("stores_tg").alias("tg"), F.sum("stores_real").alias("real"),
        F.sum(F.col("ef_prod") + F.col("ef_hc") + F.col("ef_maturity")).alias("effects"))
    gap = F.col("real") - F.col("tg")
    r0 = lambda x: round_half_away(x, 0)
    return t.select("q", r0(F.col("tg")).alias("target_total"), r0(F.col("real")).alias("real_total"), r0(gap).alias("desvio_total"),
                    round_half_away(safe_div(gap, F.col("tg")) * 100, 1).alias("desvio_pct"), r0(F.col("effects")).alias("effects_total"),
                    r0(F.col("effects") - gap).alias("cierre_check"))


# ------------------------------------------------------------------ HT bridge
def _aging_cat_of_key(key):
    """Normalized target aging -> funnel aging category (inner join map)."""
    expr = None
    for cat, label in AGING_LABELS.items():
        lab = label.upper()
        expr = F.when(key == lab, F.lit(cat)) if expr is None else expr.when(key == lab, F.lit(cat))
    return expr


def _ht_target_wide(target: DataFrame, funnel: DataFrame, mode: str, quarter: str | None, exclude: DataFrame | None) -> DataFrame:
    """Targets of valid (week, country), one row per cell (aggregated by kind, so duplicates can't multiply)."""
    wv = valid_weeks(funnel, mode, quarter, by=("country",), exclude=exclude)
    t = in_quarter(target, quarter).join(wv, ["q", "week", "country"], "left_semi")
    kind, val = F.col("tipo_target"), F.col("target")
    return (t.groupBy("q", "week", "country", norm_key("aging").alias("aging_norm"))
            .agg(F.avg(F.when(kind == "HC", val)).alias("tg_hc"),
                 F.avg(F.when(kind == "PRODUCTIVIDAD", val)).alias("tg_prod"),
                 F.sum(F.when(kind == "STORES", val)).alias("tg_stores")))


def _ht_marked(wide: DataFrame) -> DataFrame:
    """The aging category of every target cell, whether it belongs to the
    target universe (mapped aging, a headcount target), and implied days per person."""
    hp = F.col("tg_hc") * F.col("tg_prod")
    wide = wide.withColumn("aging_cat", _aging_cat_of_key(F.col("aging_norm")))
    return (wide.withColumn("has_target", F.col("tg_hc").isNotNull() & F.col("aging_cat").isNotNull())
            .withColumn("dias_pp_tg", F.when(hp > 0, F.col("tg_stores") / F.nullif(hp, F.lit(0.0)))))


def bridge_ht_target_base(target: DataFrame, funnel: DataFrame, mode: str = "QTD",
                          quarter: str | None = None, exclude: DataFrame | None = None) -> DataFrame:
    """Target universe of the HT bridge: one wide row per cell with implied days per person ``dias_pp_tg``."""
    return _ht_marked(_ht_target_wide(target, funnel, mode, quarter, exclude)).where("has_target").drop("has_target")


def bridge_ht_real(funnel: DataFrame, mode: str = "QTD", quarter: str | None = None,
                   exclude: DataFrame | None = None) -> DataFrame:
    """Real per (q, week, aging, country), every HC value included."""
    cells = _reduced(funnel, ht_real_cells, quarter)
    weeks = valid_weeks(cells, mode, exclude=exclude)
    return _in_weeks(cells.withColumnRenamed("week_date", "week"), weeks, mode, exclude).select(
        "q", "week", "aging_category_final", "country", "hc_real", "dias_real",
        "stores_real", safe_div("stores_real", "dias_real").alias("prod_real"),
        safe_div("dias_active", "hc_real").alias("dias_pp_real"))


def bridge_ht_all_cells(funnel: DataFrame, target: DataFrame, mode: str = "QTD", quarter: str | None = None,
                        exclude: DataFrame | None = None) -> DataFrame:
    """Every target cell FULL OUTER JOIN real: ``has_target`` tells the target
    universe, ``has_real`` the cells with a real side. In the universe missing
    real productivity or days per person fall back to the target's (no
    penalty without data); other target cells only bear official stores."""
    cells = _reduced(funnel, ht_real_cells, quarter)
    t = _ht_marked(_ht_target_wide(target, cells, mode, quarter, exclude)).alias("t")
    r = bridge_ht_real(cells, mode, quarter, exclude).withColumn("has_real", F.lit(True)).alias("r")
    cond = [F.col("t.q") == F.col("r.q"), F.col("t.week") == F.col("r.week"),
            F.col("t.country") == F.col("r.country"), F.col("t.aging_cat") == F.col("r.aging_category_final")]
    both = lambda c: F.coalesce(f"t.{c}", f"r.{c}").alias(c)
    return t.join(r, cond, "full_outer").select(
        both("q"), both("week"), both("country"), "t.aging_norm", F.coalesce("t.aging_cat", "r.aging_category_final").alias("aging_cat"),
        "t.tg_hc", "t.tg_prod", "t.tg_stores", "t.dias_pp_tg",
        F.coalesce("r.hc_real", F.lit(0)).cast("bigint").alias("hc_real"),
        F.coalesce("r.dias_real", F.lit(0)).cast("bigint").alias("dias_real"),
        F.coalesce("r.stores_real", F.lit(0)).cast("bigint").alias("stores_real"),
        F.coalesce("r.prod_real", "t.tg_prod").alias("prod_real"),
        F.coalesce("r.dias_pp_real", "t.dias_pp_tg").alias("dias_pp_real"),
        F.coalesce("t.has_target", F.lit(False)).alias("has_target"), F.coalesce("r.has_real", F.lit(False)).alias("has_real"))


def bridge_ht_cells(funnel: DataFrame, target: DataFrame, mode: str = "QTD",
                    quarter: str | None = None, exclude: DataFrame | None = None) -> DataFrame:
    """The cells of the target universe with their real values."""
    return bridge_ht_all_cells(funnel, target, mode, quarter, exclude).where("has_target").drop("has_target", "has_real")


def _ht_worlds_raw(cells: DataFrame, zero_hc: str) -> DataFrame:
    """The worlds per quarter, unrounded, from target cells or all cells."""
    from pyspark.sql import Window as W
    own = F.col("has_target") if "has_target" in cells.columns else F.lit(True)
    ok = own & F.col("dias_pp_tg").isNotNull()
    s0 = F.col("tg_hc") * F.col("dias_pp_tg") * F.col("tg_prod")
    s1 = F.col("tg_hc") * F.col("dias_pp_tg") * F.col("prod_real")
    s2 = F.col("hc_real") * F.col("dias_pp_tg") * F.col("prod_real")
    # Week-country totals via a window over a handful of aging cells.
    wcw = W.partitionBy("q", "week", "country")
    c = (cells.withColumn("tg_hc_total", F.sum(F.when(ok, F.col("tg_hc"))).over(wcw))
         .withColumn("hc_real_total", F.sum(F.when(own, F.col("hc_real"))).over(wcw)))
    s2m = (F.col("tg_hc_total") * (F.col("hc_real") / F.nullif(F.col("hc_real_total"), F.lit(0)))
           * F.col("dias_pp_tg") * F.col("prod_real"))
    if zero_hc == "headcount":
        s2m = F.when(F.col("hc_real_total") == 0, s1).otherwise(s2m)
    elif zero_hc != "maturity":
        raise ValueError("zero_hc must be 'maturity' or 'headcount'")
    return c.groupBy("q").agg(
        F.sum("tg_stores").alias("tg"), F.sum(F.when(ok, s0)).alias("s0"), F.sum(F.when(ok, s1)).alias("s1"),
        F.sum(F.when(ok & F.col("tg_hc_total").isNotNull(), s2m)).alias("s2m"),
        F.sum(F.when(ok, s2)).alias("s2"), F.sum(F.when(own, F.col("stores_real"))).cast("double").alias("s3"),
        F.coalesce(F.sum(F.when(~own, F.col("stores_real"))), F.lit(0)).cast("double").alias("no_target"))


def bridge_ht_worlds(cells: DataFrame, zero_hc: str = "maturity") -> DataFrame:
    """The five worlds per quarter.

    S0 all target; S1 real productivity; S2m real aging mix at target
    volume; S2 real headcount; S3 real stores. Cells without implied target
    days are left out of S0..S2. ``zero_hc``: where a week-country has no
    active rep, "maturity" (the SQL rule) drops it from S2m; "headcount"
    keeps the target mix there, so the loss shows up as headcount.
    """
    return _ht_worlds_raw(cells, zero_hc).select("q", *[round_half_away(c, 1).alias(c) for c in ("s0", "s1", "s2m", "s2", "s3")])


def bridge_ht_target_official(target: DataFrame, funnel: DataFrame, mode: str = "QTD",
                              quarter: str | None = None, exclude: DataFrame | None = None) -> DataFrame:
    """Official STORES target over valid (week, country), per quarter."""
    wide = _ht_target_wide(target, funnel, mode, quarter, exclude)
    return (wide.groupBy("q").agg(round_half_away(F.sum("tg_stores"), 1).alias("target_oficial"))
            .where(F.col("target_oficial").isNotNull()))


def bridge_ht(funnel: DataFrame, target: DataFrame, mode: str = "QTD", quarter: str | None = None,
              zero_hc: str = "maturity", exclude: DataFrame | None = None) -> DataFrame:
    """HT bridge per quarter: effects as differences of consecutive worlds,
    rounded last, and ``ef_sin_target``, the real stores of cells without a
    target, so that the reconstructed target and all effects add up to every
    real store (``actual_total``). ``actual`` is the real total of the target
    universe (S3); gaps are against the official target."""
    return bridge_ht_of(bridge_ht_all_cells(funnel, target, mode, quarter, exclude), zero_hc)


def bridge_ht_of(all_cells: DataFrame, zero_hc: str = "maturity") -> DataFrame:
    """The HT bridge from ``bridge_ht_all_cells``."""
    w = _ht_worlds_raw(all_cells, zero_hc)
    r1 = lambda x: round_half_away(x, 1)
    s0, s1, s2m, s2, s3, no, t = (F.col(c) for c in ("s0", "s1", "s2m", "s2", "s3", "no_target", "tg"))
    return w.select(
        "q", r1(t).alias("target_oficial"), r1(s0).alias("target_reconstruido"), r1(s1 - s0).alias("ef_prod"),
        r1(s2m - s1).alias("ef_madurez"), r1(s2 - s2m).alias("ef_hc"), r1(s3 - s2).alias("ef_ausencias"),
        r1(no).alias("ef_sin_target"), r1(s3).alias("actual"), r1(s3 + no).alias("actual_total"),
        r1(s3 - t).alias("desvio_vs_tg_oficial"), r1(safe_div(s3 - t, t) * 100).alias("desvio_pct"))


def shapley_ht_cells(funnel: DataFrame, target: DataFrame, mode: str = "QTD", quarter: str | None = None,
                     exclude: DataFrame | None = None) -> DataFrame:
    """HT cells for the Shapley bridge: real and target of every
    (q, country, week, aging), unmapped agings on both sides included."""
    return shapley_ht_cells_of(bridge_ht_all_cells(funnel, target, mode, quarter, exclude))


def shapley_ht_cells_of(all_cells: DataFrame) -> DataFrame:
    """The Shapley cells from ``bridge_ht_all_cells``: its target and real sides under one aging."""
    return all_cells.groupBy("q", "country", "week", F.coalesce("aging_cat", "aging_norm").alias("aging")).agg(
        F.sum("dias_real").alias("dias_real"), F.sum("stores_real").alias("stores_real"),
        F.coalesce(F.sum("tg_stores"), F.lit(0.0)).alias("stores_tg"), F.coalesce(F.sum("tg_prod"), F.lit(0.0)).alias("prod_tg"))


def unmatched_real(funnel: DataFrame, target: DataFrame, mode: str = "QTD",
                   quarter: str | None = None) -> DataFrame:
    """Real stores in cells that have no target cell: per quarter, unmatched
    vs total real stores, from one pass over all cells."""
    c = bridge_ht_all_cells(funnel, target, mode, quarter).where(F.col("has_target") | F.col("has_real"))
    real = (F.col("hc_real") > 0) | (F.col("stores_real") != 0) | (F.col("dias_real") != 0)
    miss = ~F.col("has_target")
    return c.where(miss | real).groupBy("q").agg(
        F.sum("stores_real").alias("total_real_stores"),
        F.coalesce(F.sum(F.when(miss, F.col("stores_real"))), F.lit(0)).cast("bigint").alias("unmatched_stores"),
        F.count(F.when(miss, F.lit(1))).cast("bigint").alias("unmatched_cells"))
