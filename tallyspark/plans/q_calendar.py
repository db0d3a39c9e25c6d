"""Registered queries: calendar and alignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.operators import calendar as C
from tallyspark.plans.common import AS_OF, TZ
from tallyspark.plans.oracle_tables import with_tables
from tallyspark.plans.registry import query
from tallyspark.sources import model as TD
from tallyspark.sources.tables import read_table

_WEEKS_WITH_REAL = "EXISTS (SELECT 1 FROM is_funnel f WHERE f.q = t.q AND f.week_date = t.week)"


@query("week_axis", with_tables("SELECT DISTINCT q, week FROM elc_target"))
def week_axis(spark, d):
    return C.week_axis(TD.elc_target(spark, d))


@query("weeks_available", with_tables("SELECT DISTINCT q, week_date AS week FROM is_funnel"))
def weeks_available(spark, d):
    return C.weeks_available(TD.is_funnel(spark, d))


@query("last_week", with_tables("SELECT q, MAX(week_date) AS last_week FROM is_funnel GROUP BY q"))
def last_week(spark, d):
    return C.last_week(TD.is_funnel(spark, d))


@query("align_weeks", with_tables(f"SELECT * FROM is_target t WHERE {_WEEKS_WITH_REAL}"))
def align_weeks(spark, d):
    return C.align_weeks(TD.is_target(spark, d), TD.is_funnel(spark, d), mode="QTD")


@query("align_weeks_lw", with_tables("""
SELECT t.* FROM is_target t
JOIN (SELECT q, MAX(week_date) AS lw FROM is_funnel GROUP BY q) l ON t.q = l.q AND t.week = l.lw"""))
def align_weeks_lw(spark, d):
    return C.align_weeks(TD.is_target(spark, d), TD.is_funnel(spark, d), mode="LW")


@query("closed_weeks", with_tables(f"""
SELECT DISTINCT q, week FROM elc_target
WHERE week < CAST(date_trunc('week', TIMESTAMP '{AS_OF}' - INTERVAL 5 HOUR) AS DATE)"""))
def closed_weeks(spark, d):
    # Bogota is UTC-5 all year; the oracle states the offset directly.
    return C.closed_weeks(C.week_axis(TD.elc_target(spark, d)), AS_OF, TZ)


@query("snapshot_day", """
SELECT event_id, ts,
       CAST(CAST(ts AS TIMESTAMP) - INTERVAL 5 HOUR - INTERVAL 8 HOUR - INTERVAL 15 MINUTE AS DATE) AS snapshot_day
FROM events""")
def snapshot_day(spark, d):
    ev = read_table(spark, d, "events").select("event_id", "ts")
    return C.snapshot_day(ev, "ts", cutoff="08:15", tz=TZ)


# Each fact with its weeks and the targets that meet them.
_FACTS = {"IS": ("is_funnel", "week_date", "is_target"), "HT": ("ht_funnel", "week_date", "ht_target"),
          "ELC": ("elc_funnel", "week", "elc_target")}


def _alignment_sql(source: str, facts: str, targets: str) -> str:
    return f"""
SELECT '{source}' AS source, COALESCE(r.q, t.q) AS q, r.lo AS min_week_real, r.hi AS max_week_real, COALESCE(r.n, 0) AS n_weeks_real,
       COALESCE(t.n, 0) AS n_weeks_target_used, COALESCE(t.n, 0) <= COALESCE(r.n, 0) AS ok
FROM (SELECT q, MIN(week) AS lo, MAX(week) AS hi, COUNT(DISTINCT week) AS n FROM ({facts}) GROUP BY q) r
FULL OUTER JOIN (SELECT q, COUNT(DISTINCT week) AS n FROM ({targets}) WHERE (q, week) IN (SELECT (q, week) FROM ({facts})) GROUP BY q) t ON r.q = t.q"""


@query("alignment_report", with_tables(" UNION ALL ".join(
    [_alignment_sql(n, f"SELECT q, {w} AS week FROM {f}", f"SELECT q, week FROM {t}") for n, (f, w, t) in _FACTS.items()]
    + [_alignment_sql("CHURN", "SELECT a.q, c.week FROM churn_detail c JOIN (SELECT DISTINCT q, week FROM elc_target) a ON a.week = c.week",
                      "SELECT a.q, a.week FROM churn_target c JOIN (SELECT DISTINCT q, week FROM elc_target) a ON a.week = CAST(c.week AS DATE)")])))
def alignment_report(spark, d):
    """Every fact with its targets; the churn tables have no quarter and take it from the week axis."""
    tables = {}
    for name, (funnel, week, target) in _FACTS.items():
        f, t = getattr(TD, funnel)(spark, d), getattr(TD, target)(spark, d)
        tables[name] = (f, C.align_weeks(t, f, mode="QTD", funnel_week=week), week, "week")
    axis = C.week_axis(TD.elc_target(spark, d))
    churn = TD.churn_detail(spark, d).join(axis, "week").select("q", "week")
    goals = TD.churn_target(spark, d).select(F.col("week").cast("date").alias("week")).join(axis, "week").select("q", "week")
    tables["CHURN"] = (churn, C.align_weeks(goals, churn, funnel_week="week"), "week", "week")
    return C.alignment_of(tables)
