"""Generic target -> actual bridge by Shapley decomposition.

Drivers: productivity (stores per day within each aging), capacity (total
days) and maturity (the aging mix of days). Per group (default quarter x
project x country x week):

    v(S) = C_x * sum_a m_y[a] * p_z[a]

where each driver in coalition S takes its real value and the others the
target's (target days per aging = stores target / productivity target).
The Shapley value of each driver averages its marginal contribution over
the 3! orders (weights 1/3, 1/6, 1/6, 1/3), so the three effects add up
exactly to v(real) - v(target): no residual. If a side has no days in an
aging its productivity falls back to the other side's; with no days at all
the shares do. Stores made on zero days (or target stores with a zero
productivity target) are no product of days and productivity; they are a
term of the productivity driver,

    v(S) = C_x * sum_a m_y[a] * p_z[a] + zero_z

so the coalitions run from the whole target to every real store and the
effects leave no residual. The ``zero_*`` columns show that term.

Only sums over agings are needed, so everything is two aggregations over
the cells (group, then output grain); no pairs of rows are formed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from tallyspark.functions.exprs import round_half_away

THIRD, SIXTH = 1.0 / 3.0, 1.0 / 6.0


def shapley_bridge(cells: DataFrame, group: tuple[str, ...] = ("q", "proyecto", "country", "week"),
                   out: tuple[str, ...] = ("q", "proyecto")) -> DataFrame:
    """``cells``: one row per (group..., aging) with dias_real, stores_real,
    stores_tg, prod_tg (e.g. ``bridge_is_cells``)."""
    dr, sr = F.col("dias_real").cast("double"), F.col("stores_real").cast("double")
    st, pt = F.col("stores_tg"), F.col("prod_tg")
    dt = F.when(pt > 0, st / F.nullif(pt, F.lit(0.0))).otherwise(F.lit(0.0))
    c = cells.select(*group, dr.alias("dr"), sr.alias("sr"), st.alias("st"), pt.alias("pt"), dt.alias("dt"))
    pr_raw = F.col("sr") / F.nullif(F.col("dr"), F.lit(0.0))
    p_r = (F.when(F.col("dr") > 0, pr_raw).when(F.col("dt") > 0, F.col("pt")).otherwise(F.lit(0.0)))
    p_t = (F.when(F.col("dt") > 0, F.col("pt")).when(F.col("dr") > 0, pr_raw).otherwise(F.lit(0.0)))
    g = W.partitionBy(*group)  # at most a handful of aging cells per group
    c = c.select("*", F.sum("dr").over(g).alias("cr"), F.sum("dt").over(g).alias("ct"),
                 p_r.alias("p_r"), p_t.alias("p_t"))
    share_r = F.col("dr") / F.nullif(F.col("cr"), F.lit(0.0))
    share_t = F.col("dt") / F.nullif(F.col("ct"), F.lit(0.0))
    m_r = F.when(F.col("cr") > 0, share_r).when(F.col("ct") > 0, share_t).otherwise(F.lit(0.0))
    m_t = F.when(F.col("ct") > 0, share_t).when(F.col("cr") > 0, share_r).otherwise(F.lit(0.0))
    c = c.select("*", m_r.alias("m_r"), m_t.alias("m_t"))
    a = c.groupBy(*group).agg(
        F.first("cr").alias("cr"), F.first("ct").alias("ct"),
        F.sum(F.col("m_t") * F.col("p_t")).alias("a_tt"), F.sum(F.col("m_t") * F.col("p_r")).alias("a_tr"),
        F.sum(F.col("m_r") * F.col("p_t")).alias("a_rt"), F.sum(F.col("m_r") * F.col("p_r")).alias("a_rr"),
        F.sum("sr").alias("real_total"), F.sum("st").alias("target_total"),
        F.sum(F.when(F.col("dr") > 0, F.lit(0.0)).otherwise(F.col("sr"))).alias("z_r"),
        F.sum(F.when(F.col("dt") > 0, F.lit(0.0)).otherwise(F.col("st"))).alias("z_t"))
    cr, ct = F.col("cr"), F.col("ct")
    v0, vP, vM, vPM = ct * F.col("a_tt"), ct * F.col("a_tr"), ct * F.col("a_rt"), ct * F.col("a_rr")
    vC, vPC, vMC, vA = cr * F.col("a_tt"), cr * F.col("a_tr"), cr * F.col("a_rt"), cr * F.col("a_rr")
    # The zero-day term moves with productivity alone, so it enters each of that driver's steps whole.
    phi_p = THIRD * (vP - v0) + SIXTH * (vPC - vC) + SIXTH * (vPM - vM) + THIRD * (vA - vMC) + F.col("z_r") - F.col("z_t")
    phi_c = THIRD * (vC - v0) + SIXTH * (vPC - vP) + SIXTH * (vMC - vM) + THIRD * (vA - vPM)
    phi_m = THIRD * (vM - v0) + SIXTH * (vPM - vP) + SIXTH * (vMC - vC) + THIRD * (vA - vPC)
    per = a.select(*group, "real_total", "target_total", "z_r", "z_t",
                   phi_p.alias("phi_p"), phi_c.alias("phi_c"), phi_m.alias("phi_m"))
    s = per.groupBy(*out).agg(*[F.sum(c).alias(c) for c in ("target_total", "z_t", "phi_p", "phi_c", "phi_m", "z_r", "real_total")])
    r = lambda x, name: round_half_away(x, 6).alias(name)
    return s.select(
        *out, r(F.col("target_total"), "target_total"), r(F.col("z_t"), "zero_day_target"), r(F.col("phi_p"), "ef_productivity"),
        r(F.col("phi_c"), "ef_capacity"), r(F.col("phi_m"), "ef_maturity"), r(F.col("z_r"), "zero_day_real"), r(F.col("real_total"), "real_total"),
        r(F.col("target_total") + F.col("phi_p") + F.col("phi_c") + F.col("phi_m") - F.col("real_total"), "closure"))
