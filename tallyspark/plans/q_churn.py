"""Registered queries: early churn."""

from __future__ import annotations

from tallyspark.operators import calendar as C
from tallyspark.operators import churn as CH
from tallyspark.plans.common import AS_OF, TZ, round_doubles
from tallyspark.plans.oracle_tables import rha, with_tables
from tallyspark.plans.registry import query
from tallyspark.sources import model as TD

# Stated from the rules: a list of channels, one aggregation over both grains, targets as a long list.
_CHURN_CTES = {
    "open_weeks": f"""SELECT DISTINCT q, week FROM elc_target
               WHERE week < CAST(date_trunc('week', TIMESTAMP '{AS_OF}' - INTERVAL 5 HOUR) AS DATE)""",
    "channels": """SELECT * FROM (VALUES ('HUNTING', 'HUNTING', 1), ('INSIDE SALES', 'IS', 2), ('SELF-ONBOARDING', 'SOB', 3),
               ('BRAND EXPANSION', 'BE', 4), (NULL, 'TOTAL', 5)) c(team, canal, canal_rank)""",
    "lost": """
SELECT w.q, d.week, d.age, CASE WHEN GROUPING(c.canal) = 1 THEN 'TOTAL' ELSE c.canal END AS canal,
       CAST(SUM(d.churn) AS BIGINT) AS churn_stores, CAST(SUM(d.total_store) AS BIGINT) AS total_stores,
       SUM(d.churn) / NULLIF(SUM(d.total_store), 0) AS churn_ratio
FROM churn_detail d JOIN open_weeks w USING (week) LEFT JOIN channels c ON c.team = UPPER(d.channel_am)
WHERE d.country <> 'BR'
GROUP BY GROUPING SETS ((w.q, d.week, d.age, c.canal), (w.q, d.week, d.age))
HAVING GROUPING(c.canal) = 1 OR c.canal IS NOT NULL""",
    "goals": """
SELECT week, canal, age, AVG(goal) AS target_pct
FROM (SELECT CAST(week AS DATE) AS week, channel_am AS canal, unnest(['M1', 'M2', 'M3']) AS age,
             unnest(["TARGET_%CHURN_M1", "TARGET_%CHURN_M2", "TARGET_%CHURN_M3"]) AS goal
      FROM churn_target WHERE country = 'TOTAL') GROUP BY ALL""",
    "early": f"""
SELECT q, week, age, canal, churn_stores, total_stores, churn_pct, target_pct, {rha('(churn_pct - target_pct) * 100', 1)} AS delta_pp, churn_ratio, canal_rank
FROM (SELECT *, {rha('churn_ratio * 100', 1)} / 100 AS churn_pct FROM lost)
LEFT JOIN goals USING (week, canal, age) LEFT JOIN channels USING (canal)""",
}


def _early(spark, d):
    return CH.early_churn(TD.churn_detail(spark, d), TD.churn_target(spark, d),
                          C.week_axis(TD.elc_target(spark, d)), AS_OF, TZ)


_EARLY_SELECT = f"""
SELECT q, week, age, canal, churn_stores, total_stores, {rha('churn_pct', 6)} AS churn_pct,
       {rha('target_pct', 6)} AS target_pct, delta_pp, ABS(delta_pp) > 40 AS is_anomaly,
       {rha('churn_ratio', 6)} AS churn_ratio, canal_rank
FROM early"""


@query("early_churn", with_tables(_EARLY_SELECT, extra=_CHURN_CTES))
def early_churn(spark, d):
    return round_doubles(_early(spark, d))


@query("churn_anomalies", with_tables(f"SELECT * FROM ({_EARLY_SELECT}) WHERE is_anomaly", extra=_CHURN_CTES))
def churn_anomalies(spark, d):
    return round_doubles(CH.churn_anomalies(_early(spark, d)))


@query("churn_qtd", with_tables(f"""
SELECT q, age, canal, CAST(SUM(churn_stores) AS BIGINT) AS churn_stores,
       CAST(SUM(total_stores) AS BIGINT) AS total_stores,
       {rha('SUM(churn_stores) / NULLIF(SUM(total_stores), 0)', 6)} AS churn_qtd,
       {rha('SUM(CASE WHEN target_pct IS NOT NULL THEN target_pct * total_stores END) / NULLIF(SUM(CASE WHEN target_pct IS NOT NULL THEN total_stores END), 0)', 6)} AS target_qtd,
       {rha('SUM(churn_stores) / NULLIF(SUM(total_stores), 0) - SUM(CASE WHEN target_pct IS NOT NULL THEN target_pct * total_stores END) / NULLIF(SUM(CASE WHEN target_pct IS NOT NULL THEN total_stores END), 0)', 6)} AS gap_qtd,
       COUNT(*) AS weeks, COUNT(target_pct) AS weeks_with_target
FROM early GROUP BY q, age, canal""", extra=_CHURN_CTES))
def churn_qtd(spark, d):
    return round_doubles(CH.churn_qtd(_early(spark, d)))


@query("churn_completeness", with_tables("""
SELECT g.q, g.week, a.age, c.canal
FROM (SELECT DISTINCT q, week FROM early) g,
     (VALUES ('M1'), ('M2'), ('M3')) a(age),
     (VALUES ('HUNTING'), ('IS'), ('SOB'), ('BE'), ('TOTAL')) c(canal)
WHERE NOT EXISTS (SELECT 1 FROM early e WHERE e.q = g.q AND e.week = g.week AND e.age = a.age
                  AND e.canal = c.canal)""", extra=_CHURN_CTES))
def churn_completeness(spark, d):
    return CH.churn_completeness(_early(spark, d))
