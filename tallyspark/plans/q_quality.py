"""Registered queries: portfolio quality and store detail."""

from __future__ import annotations

from tallyspark.operators import quality as X
from tallyspark.operators import stores as P
from tallyspark.plans.common import TZ, round_doubles
from tallyspark.plans.oracle_tables import rha, with_tables
from tallyspark.plans.registry import query
from tallyspark.sources import model as TD
from tallyspark.sources.tables import read_table

_COUNTS_SQL = """
CAST(COUNT(*) AS BIGINT) AS total_store,
CAST(SUM(CASE WHEN first_login IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS store_sin_fl,
CAST(SUM(CASE WHEN orders_0_28 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS store_sin_orders,
CAST(SUM(CASE WHEN handoff <> 'COMPLETED' THEN 1 ELSE 0 END) AS BIGINT) AS store_sin_handoff,
CAST(SUM(CASE WHEN first_login IS NOT NULL AND orders_0_28 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS churn,
CAST(SUM(CASE WHEN first_login IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS total_store_churn"""

_RATES_SQL = ", ".join([
    f"{rha('store_sin_fl / NULLIF(total_store, 0)', 6)} AS store_sin_login_rate",
    f"{rha('store_sin_orders / NULLIF(total_store, 0)', 6)} AS pct_sin_orders",
    f"{rha('store_sin_handoff / NULLIF(total_store, 0)', 6)} AS pct_sin_handoff",
    f"{rha('churn / NULLIF(total_store_churn, 0)', 6)} AS churn_rate"])

_GOLD = f"SELECT hunter_, coordinador, channel, {_COUNTS_SQL} FROM store_detail GROUP BY ALL"


def _silver(spark, d):
    return TD.store_detail(spark, d)


@query("quality_gold", with_tables(f"SELECT *, {_RATES_SQL} FROM gold", extra={"gold": _GOLD}))
def quality_gold(spark, d):
    return round_doubles(X.quality_gold(_silver(spark, d)))


@query("churn_rate", with_tables(f"""
SELECT hunter_, coordinador, channel, churn, total_store_churn,
       {rha('churn / NULLIF(total_store_churn, 0)', 6)} AS churn_rate FROM gold""", extra={"gold": _GOLD}))
def churn_rate(spark, d):
    g = X.quality_gold(_silver(spark, d))
    return round_doubles(g.select("hunter_", "coordinador", "channel", "churn", "total_store_churn", "churn_rate"))


@query("quality_rates", with_tables(f"""
SELECT hunter_, coordinador, channel, total_store, store_sin_fl, store_sin_orders, store_sin_handoff,
       {rha('store_sin_fl / NULLIF(total_store, 0)', 6)} AS store_sin_login_rate,
       {rha('store_sin_orders / NULLIF(total_store, 0)', 6)} AS pct_sin_orders,
       {rha('store_sin_handoff / NULLIF(total_store, 0)', 6)} AS pct_sin_handoff FROM gold""",
    extra={"gold": _GOLD}))
def quality_rates(spark, d):
    g = X.quality_gold(_silver(spark, d))
    return round_doubles(g.select("hunter_", "coordinador", "channel", "total_store", "store_sin_fl",
                                  "store_sin_orders", "store_sin_handoff", "store_sin_login_rate",
                                  "pct_sin_orders", "pct_sin_handoff"))


@query("hunter_ranking", with_tables(f"""
SELECT *, {_RATES_SQL}, ROW_NUMBER() OVER (ORDER BY store_sin_fl DESC, hunter_ NULLS FIRST) AS rank FROM (
  SELECT hunter_, {', '.join(f'CAST(SUM({c}) AS BIGINT) AS {c}' for c in X.COUNTS)} FROM gold GROUP BY hunter_)""",
    extra={"gold": _GOLD}))
def hunter_ranking(spark, d):
    return round_doubles(X.hunter_ranking(X.quality_gold(_silver(spark, d))))


@query("quality_by_dim", with_tables(f"""
SELECT *, {_RATES_SQL} FROM (
  SELECT 'hunter_' AS dim, hunter_ AS value, {_COUNTS_SQL} FROM store_detail GROUP BY hunter_
  UNION ALL SELECT 'coordinador', coordinador, {_COUNTS_SQL} FROM store_detail GROUP BY coordinador
  UNION ALL SELECT 'channel', channel, {_COUNTS_SQL} FROM store_detail GROUP BY channel)"""))
def quality_by_dim(spark, d):
    return round_doubles(X.quality_by_dim(_silver(spark, d)))


_WO = {
    "long": """SELECT hunter_, store_id, first_login, 'razon_social' AS entity_type, razon_social AS entity FROM store_detail
               UNION ALL SELECT hunter_, store_id, first_login, 'brand_name', brand_name FROM store_detail
               UNION ALL SELECT hunter_, store_id, first_login, 'adress', adress FROM store_detail""",
    "per": """SELECT hunter_, entity_type, entity, COUNT(*) AS total_store_wo,
                     CAST(SUM(CASE WHEN first_login IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS store_sin_login_wo
              FROM long GROUP BY ALL""",
    "wo": """SELECT hunter_, entity_type, entity, total_store_wo, store_sin_login_wo FROM (
               SELECT *, ROW_NUMBER() OVER (PARTITION BY hunter_, entity_type
                                            ORDER BY store_sin_login_wo DESC, total_store_wo DESC, entity) AS rn
               FROM per) WHERE rn = 1""",
}


@query("worst_offender", with_tables("SELECT * FROM wo", extra=_WO))
def worst_offender(spark, d):
    return X.worst_offender(_silver(spark, d))


@query("offender_stores", with_tables("""
SELECT l.store_id, l.hunter_, l.entity_type, l.entity, s.fecha_envio_de_credenciales, s.first_login, s.handoff,
       s.orders_0_28
FROM long l JOIN wo ON l.hunter_ = wo.hunter_ AND l.entity_type = wo.entity_type AND l.entity = wo.entity
JOIN store_detail s ON l.store_id = s.store_id""", extra=_WO))
def offender_stores(spark, d):
    s = _silver(spark, d)
    return X.offender_stores(s, X.worst_offender(s))


# The stored GOLD table is what a refresh made before the last stores got their credentials.
GOLD_AS_OF, STORED_BEFORE = "1993-07-18", "1993-03-01"


def _gold_sql(silver: str) -> str:
    """One row a rep from ``silver``; each offender by its own ordered pick."""
    picks, joins = [], []
    for i, e in enumerate(X.ENTITIES):
        joins.append(f"""LEFT JOIN (
  SELECT * FROM (SELECT hunter_, {e} AS entity, COUNT(*) AS n, COUNT(*) FILTER (WHERE first_login IS NULL) AS bad,
                        ROW_NUMBER() OVER (PARTITION BY hunter_ ORDER BY COUNT(*) FILTER (WHERE first_login IS NULL) DESC, COUNT(*) DESC, {e}) AS rn
                 FROM {silver} GROUP BY hunter_, {e}) WHERE rn = 1) w{i} ON w{i}.hunter_ IS NOT DISTINCT FROM g.hunter_""")
        picks.append(f"w{i}.entity AS {e}_wo, w{i}.n AS total_store_{e}_wo, w{i}.bad AS store_sin_login_{e}_wo")
    month = f"date_trunc('month', DATE '{GOLD_AS_OF}')"
    m1 = f"first_login >= {month} - INTERVAL 1 MONTH AND first_login < {month}"
    return f"""
SELECT g.*, {', '.join(picks)} FROM (
  SELECT hunter_, {_COUNTS_SQL},
         {rha('COUNT(*) FILTER (WHERE first_login IS NULL) / NULLIF(COUNT(*), 0)', 6)} AS store_sin_login_rate,
         {rha(f'COUNT(*) FILTER (WHERE {m1} AND orders_0_28 = 0) / NULLIF(COUNT(*) FILTER (WHERE {m1}), 0)', 6)} AS churnm1
  FROM {silver} GROUP BY hunter_) g {' '.join(joins)}"""


@query("quality_gold_wide", with_tables(_gold_sql("store_detail")))
def quality_gold_wide(spark, d):
    return X.gold_table(_silver(spark, d), GOLD_AS_OF)


def _stored_gold(spark, d):
    silver = _silver(spark, d)
    return TD.derived(spark, d, "gold_stored", lambda: X.gold_table(
        silver.where(silver["fecha_envio_de_credenciales"] < STORED_BEFORE), GOLD_AS_OF), ("hunter_",))


_GOLD_FIELDS = [*X.COUNTS, "store_sin_login_rate", "churnm1",
                *[c for e in X.ENTITIES for c in (f"{e}_wo", f"total_store_{e}_wo", f"store_sin_login_{e}_wo")]]


def _told(side: str, c: str) -> str:
    return f"CAST(CAST({side}.{c} AS DECIMAL(18, 6)) AS VARCHAR)" if c in ("store_sin_login_rate", "churnm1") else f"CAST({side}.{c} AS VARCHAR)"


@query("gold_check", with_tables("SELECT hunter_, field, stored, derived, stored IS NOT DISTINCT FROM derived AS ok FROM (" + " UNION ALL ".join(
    ["SELECT COALESCE(d.hunter_, s.hunter_) AS hunter_, 'hunter_' AS field, CASE WHEN s.total_store IS NOT NULL THEN 'yes' END AS stored, "
     "CASE WHEN d.total_store IS NOT NULL THEN 'yes' END AS derived FROM s FULL OUTER JOIN d ON s.hunter_ = d.hunter_"]
    + [f"SELECT COALESCE(d.hunter_, s.hunter_), '{c}', {_told('s', c)}, {_told('d', c)} FROM s FULL OUTER JOIN d ON s.hunter_ = d.hunter_" for c in _GOLD_FIELDS])
    + ")", extra={"older": f"SELECT * FROM store_detail WHERE fecha_envio_de_credenciales < DATE '{STORED_BEFORE}'",
                  "s": _gold_sql("older"), "d": _gold_sql("store_detail")}))
def gold_check(spark, d):
    return X.gold_check(_stored_gold(spark, d), X.gold_table(_silver(spark, d), GOLD_AS_OF))


@query("low_availability", with_tables("""
SELECT store_id, hunter_, coordinador, channel, av_0_28, av_last_week, av_last_2week, av_l4w,
       av_0_28 < 0.2 AS low_0_28, av_last_week < 0.2 AS low_last_week, av_last_2week < 0.2 AS low_last_2week,
       av_l4w < 0.2 AS low_l4w
FROM store_detail WHERE av_0_28 < 0.2 OR av_last_week < 0.2 OR av_last_2week < 0.2 OR av_l4w < 0.2"""))
def low_availability(spark, d):
    return X.low_availability(_silver(spark, d), 0.2)


@query("partner_cancellations", with_tables(f"""
SELECT hunter_, COUNT(*) AS total_store,
       CAST(SUM(CASE WHEN orders_cancel_partner_0_28 >= 3 THEN 1 ELSE 0 END) AS BIGINT) AS stores_high_cancel,
       CAST(SUM(CASE WHEN orders_cancel_partner_0_28 >= 3 THEN orders_cancel_partner_0_28 ELSE 0 END) AS BIGINT)
         AS cancels_high,
       CAST(SUM(orders_cancel_partner_0_28) AS BIGINT) AS cancels_total,
       {rha('SUM(CASE WHEN orders_cancel_partner_0_28 >= 3 THEN 1 ELSE 0 END) / NULLIF(COUNT(*), 0)', 6)}
         AS share_high_cancel
FROM store_detail GROUP BY hunter_"""))
def partner_cancellations(spark, d):
    return round_doubles(X.partner_cancellations(_silver(spark, d), 3))


_NO_LOGIN = """SELECT store_id, hunter_, coordinador, channel, razon_social, brand_name, adress,
                      fecha_envio_de_credenciales
               FROM store_detail WHERE fecha_envio_de_credenciales IS NOT NULL AND first_login IS NULL"""


@query("no_login_stores", with_tables(_NO_LOGIN))
def no_login_stores(spark, d):
    return X.no_login_stores(_silver(spark, d))


@query("store_history", with_tables("""
SELECT * FROM store_history h WHERE EXISTS (SELECT 1 FROM nl WHERE nl.store_id = h.external_store_id)""",
    extra={"nl": _NO_LOGIN}))
def store_history(spark, d):
    return P.store_history(TD.store_history(spark, d), X.no_login_stores(_silver(spark, d)))


@query("store_latest", with_tables("""
SELECT external_store_id, day_date, order_id, week_date, status, order_value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY external_store_id ORDER BY day_date DESC, order_id DESC) AS rn
  FROM store_history) WHERE rn = 1"""))
def store_latest(spark, d):
    return P.store_latest(TD.store_history(spark, d))


# The refreshes asked for: the first day of every quarter that the snapshots cover.
REFRESHES = [f"{y}-{m:02d}-01" for y in range(1992, 2000) for m in (1, 4, 7, 10)]


@query("snapshots_as_of", with_tables(f"""
SELECT refresh_day, store_id, day, loaded_at, load_id, stock, status, CAST(refresh_day - day AS INTEGER) AS age_days FROM (
  SELECT r.refresh_day, s.*, ROW_NUMBER() OVER (PARTITION BY r.refresh_day, s.store_id ORDER BY s.day DESC, s.loaded_at DESC, s.load_id DESC) AS rn
  FROM store_snapshot s JOIN (SELECT CAST(unnest({REFRESHES}) AS DATE) AS refresh_day) r
    ON s.loaded_at - INTERVAL 5 HOUR < r.refresh_day + INTERVAL 8 HOUR + INTERVAL 15 MINUTE) WHERE rn = 1"""))
def snapshots_as_of(spark, d):
    return P.snapshots_as_of(TD.store_snapshot(spark, d), REFRESHES, "store_id", "day", "loaded_at", "load_id", tz=TZ)


@query("describe_columns")
def describe_columns(spark, d):
    return P.describe_columns(read_table(spark, d, "lineitem"))
