"""Registered queries: targets."""

from __future__ import annotations

from tallyspark.operators import targets as T
from tallyspark.plans.common import round_doubles
from tallyspark.plans.oracle_tables import aging_norm_sql, rha, with_tables
from tallyspark.plans.registry import query
from tallyspark.sources import model as TD

_HUNTER_DAYS = f"""
SELECT q, week_date AS week, country, {aging_norm_sql('aging_category_final')} AS aging_norm, hunter_email,
       CAST(SUM(dias_trabajados) AS BIGINT) AS dias_trabajados_reales
FROM ht_funnel WHERE hc = 1 GROUP BY ALL HAVING aging_norm IS NOT NULL"""

_PROD_TG = """
SELECT q, week, country, UPPER(TRIM(aging)) AS aging_norm, AVG(target) AS productividad_target
FROM ht_target WHERE tipo_target = 'PRODUCTIVIDAD' GROUP BY ALL"""

_IND = """
SELECT d.q, d.week, d.country, d.aging_norm, d.hunter_email, d.dias_trabajados_reales,
       t.productividad_target, t.productividad_target * d.dias_trabajados_reales AS target_stores
FROM hd d JOIN pt t ON d.q = t.q AND d.week = t.week AND d.country = t.country AND d.aging_norm = t.aging_norm"""


@query("target_by_kind", with_tables("""
SELECT q, proyecto, country, week, UPPER(TRIM(aging)) AS aging_norm,
       SUM(CASE WHEN tipo_target = 'STORES' THEN target ELSE 0.0 END) AS stores_tg,
       AVG(CASE WHEN tipo_target = 'HC' THEN target END) AS hc_tg,
       AVG(CASE WHEN tipo_target = 'PRODUCTIVIDAD' THEN target END) AS prod_tg
FROM is_target GROUP BY ALL"""))
def target_by_kind(spark, d):
    return T.target_by_kind(TD.is_target(spark, d), ["proyecto", "country", "week"])


@query("hunter_days", with_tables(_HUNTER_DAYS))
def hunter_days(spark, d):
    return T.hunter_days(TD.ht_funnel(spark, d))


@query("hunter_days_is_outbound", with_tables(f"""
SELECT q, week_date AS week, country, proyecto, {aging_norm_sql('aging_category_final')} AS aging_norm,
       hunter_email, CAST(SUM(dias_trabajados) AS BIGINT) AS dias_trabajados_reales
FROM is_funnel WHERE hc = 1 AND proyecto = 'OUTBOUND' GROUP BY ALL HAVING aging_norm IS NOT NULL"""))
def hunter_days_is_outbound(spark, d):
    return T.hunter_days(TD.is_funnel(spark, d), project="OUTBOUND")


@query("hunter_target_stores", with_tables("SELECT * FROM ind", extra={
    "hd": _HUNTER_DAYS, "pt": _PROD_TG, "ind": _IND}))
def hunter_target_stores(spark, d):
    return T.hunter_target_stores(TD.ht_funnel(spark, d), TD.ht_target(spark, d))


@query("macro_target_weekly", with_tables(f"""
SELECT q, week, SUM(target_stores) AS target_store_created,
       CAST(SUM(dias_trabajados_reales) AS BIGINT) AS dias_trabajados_reales_total,
       {rha('SUM(target_stores) / NULLIF(SUM(dias_trabajados_reales), 0)', 6)} AS target_productivity
FROM ind GROUP BY q, week""", extra={"hd": _HUNTER_DAYS, "pt": _PROD_TG, "ind": _IND}))
def macro_target_weekly(spark, d):
    return round_doubles(T.macro_target_weekly(TD.ht_funnel(spark, d), TD.ht_target(spark, d)))


@query("target_reconciliation", with_tables(f"""
SELECT COALESCE(i.q, g.q) AS q, COALESCE(i.week, g.week) AS week, i.individual_target, g.group_target,
       i.individual_target - g.group_target AS diff,
       {rha('(i.individual_target - g.group_target) / NULLIF(g.group_target, 0)', 6)} AS diff_pct
FROM (SELECT q, week, SUM(target_stores) AS individual_target FROM ind GROUP BY q, week) i
FULL OUTER JOIN (SELECT q, week, SUM(target) AS group_target FROM ht_target
                 WHERE tipo_target = 'STORES' GROUP BY q, week) g
  ON i.q = g.q AND i.week = g.week""", extra={"hd": _HUNTER_DAYS, "pt": _PROD_TG, "ind": _IND}))
def target_reconciliation(spark, d):
    return round_doubles(T.target_reconciliation(TD.ht_funnel(spark, d), TD.ht_target(spark, d)))


_GRAINS = {
    "is_target": ["q", "week", "country", "proyecto", "aging", "tipo_target"],
    "ht_target": ["q", "week", "country", "aging", "tipo_target"],
    "elc_target": ["q", "week", "country", "team", "channel_group", "tipo_target"],
    "churn_target": ["week", "country", "channel_am"],
}
_GRAIN_COLS = list(dict.fromkeys(k for keys in _GRAINS.values() for k in keys))


def _grain_sql(table: str) -> str:
    cols = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" if c in _GRAINS[table] else f"CAST(NULL AS VARCHAR) AS {c}" for c in _GRAIN_COLS)
    return f"SELECT '{table}' AS \"table\", {cols}, COUNT(*) AS n_rows FROM {table} GROUP BY ALL HAVING COUNT(*) > 1"


@query("target_grain_check", with_tables(" UNION ALL ".join(_grain_sql(t) for t in _GRAINS)))
def target_grain_check(spark, d):
    """Rows of all four target tables that stand more than once in their declared grain."""
    return T.grain_report({n: (getattr(TD, n)(spark, d), keys) for n, keys in _GRAINS.items()})
