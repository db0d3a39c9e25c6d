"""The model tables written as SQL CTEs over the raw test tables, for the
DuckDB oracle. This is an independent SQL statement of the adapter rules in
``tallyspark.sources.testdata`` (same fixed values, same rules), not code
generated from the Spark plan.

``with_tables(body, *names)`` prefixes a query with the CTEs it needs, in
dependency order.
"""

from __future__ import annotations

import re

_Q = "(CAST(year({w}) AS VARCHAR) || '-Q' || CAST(quarter({w}) AS VARCHAR))"


def qlabel(w: str) -> str:
    return _Q.format(w=w)


def wk(ts: str) -> str:
    return f"CAST(date_trunc('week', {ts}) AS DATE)"


_AGING_CASE = ("CASE WHEN s.s_suppkey % 10 = 9 THEN 'Other' WHEN s.s_suppkey % 3 = 0 THEN 'New Entry' "
               "WHEN s.s_suppkey % 3 = 1 THEN 'Junior' ELSE 'Senior' END")

CTES: dict[str, str] = {}

CTES["supplier_day"] = """
SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day,
       CASE WHEN l_linestatus = 'O' THEN 'OUTBOUND' ELSE 'INBOUND' END AS proyecto,
       MAX(CASE WHEN l_discount < 0.09 THEN 1 ELSE 0 END) AS worked,
       SUM(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) AS stores
FROM lineitem GROUP BY 1, 2, 3"""

CTES["is_funnel"] = f"""
SELECT {qlabel('w.week_date')} AS q, w.week_date, n.n_name AS country, w.proyecto,
       w.proyecto AS proyecto_agrupado, {_AGING_CASE} AS aging_category_final,
       CASE WHEN s.s_suppkey % 31 <> 5 THEN s.s_name END AS hunter_email, CASE WHEN s.s_suppkey % 7 = 0 THEN 0 ELSE 1 END AS hc,
       w.dias_trabajados, w.stores_totales
FROM (SELECT l_suppkey, {wk('day')} AS week_date, proyecto,
             CAST(SUM(worked) AS BIGINT) AS dias_trabajados, CAST(SUM(stores) AS BIGINT) AS stores_totales
      FROM supplier_day GROUP BY 1, 2, 3) w
JOIN supplier s ON w.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey"""

CTES["ht_funnel"] = f"""
SELECT {qlabel('w.week_date')} AS q, w.week_date, n.n_name AS country,
       {_AGING_CASE} AS aging_category_final,
       CASE WHEN s.s_suppkey % 31 <> 5 THEN s.s_name END AS hunter_email, CASE WHEN s.s_suppkey % 7 = 0 THEN 0 ELSE 1 END AS hc,
       w.dias_trabajados, w.stores_totales
FROM (SELECT l_suppkey, {wk('day')} AS week_date,
             CAST(SUM(worked) AS BIGINT) AS dias_trabajados, CAST(SUM(stores) AS BIGINT) AS stores_totales
      FROM (SELECT l_suppkey, day, MAX(worked) AS worked, SUM(stores) AS stores
            FROM supplier_day GROUP BY 1, 2) GROUP BY 1, 2) w
JOIN supplier s ON w.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey"""

CTES["onw"] = f"""
SELECT g.week, g.nk, n.n_name AS country, weekofyear(g.week) AS w
FROM (SELECT DISTINCT o.week, c.c_nationkey AS nk
      FROM (SELECT DISTINCT o_custkey, {wk('o_orderdate')} AS week FROM orders) o
      JOIN customer c ON o.o_custkey = c.c_custkey) g
JOIN nation n ON g.nk = n.n_nationkey"""

_TG_VALS = """
  CAST(1 + (nk + i) % 2 AS DOUBLE) AS hc_v,
  CAST(CASE WHEN i = 2 AND (nk + w) % 13 = 0 THEN 0.0 ELSE 0.5 + 0.125 * i END AS DOUBLE) AS prod_v"""

CTES["is_tcells"] = f"""
SELECT * EXCLUDE (lab), CASE WHEN prod_v = 0 THEN 1.5 ELSE hc_v * prod_v * mult END AS stores_v FROM (
  SELECT onw.*, a.i, a.lab, p.proyecto, {_TG_VALS},
    CAST(1.0 + (w % 4) * 0.5 + CASE WHEN p.proyecto = 'INBOUND' THEN 0.25 ELSE 0.0 END AS DOUBLE) AS mult,
    CASE WHEN nk % 2 = 1 THEN ' ' || upper(a.lab) || ' ' ELSE a.lab END AS aging
  FROM onw, (VALUES (1, '01 - New Entry'), (2, '02 - Junior'), (3, '03 - Senior')) a(i, lab),
       (VALUES ('OUTBOUND'), ('INBOUND')) p(proyecto)
  WHERE (nk + a.i + w) % 7 <> 0)"""

CTES["ht_tcells"] = f"""
SELECT *, CASE WHEN prod_v = 0 THEN 1.5 ELSE hc_v * prod_v * mult END AS stores_v FROM (
  SELECT onw.*, a.i, {_TG_VALS},
    CAST(1.0 + (w % 4) * 0.5 AS DOUBLE) AS mult,
    CASE a.i WHEN 1 THEN '01 - new entry' WHEN 2 THEN '02 - junior' ELSE '03 - senior' END AS aging
  FROM onw, (VALUES (1), (2), (3)) a(i)
  WHERE (nk + a.i + w) % 7 <> 0)"""


def _target_union(cells: str, extra: str) -> str:
    cols = f"{qlabel('week')} AS q, week, country, {extra}aging"
    return f"""
SELECT {cols}, 'HC' AS tipo_target, hc_v AS target FROM {cells}
UNION ALL SELECT {cols}, 'PRODUCTIVIDAD', prod_v FROM {cells}
UNION ALL SELECT {cols}, 'STORES', stores_v FROM {cells}
UNION ALL SELECT {cols}, 'HC', hc_v FROM {cells} WHERE (nk + w) % 11 = 0
UNION ALL SELECT {cols}, 'STORES', stores_v FROM {cells} WHERE (nk + w) % 11 <> 0 AND (nk + w) % 17 = 0"""


CTES["is_target"] = _target_union("is_tcells", "proyecto, ")
CTES["ht_target"] = _target_union("ht_tcells", "")

_ELC_COUNTS = [
    ("CREATED", "1 = 1"),
    ("AVAILABLE", "o.o_orderpriority <> '5-LOW'"),
    ("ACTIVE", "o.o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"),
    ("PERFECT STORE", "o.o_totalprice > 300000"),
    ("HANDOFF", "o.o_orderkey % 8 <> 7"),
    ("HANDOFF_3", "o.o_orderkey % 4 = 0"),
    ("HANDOFF_7", "o.o_orderkey % 4 <= 1"),
    ("HANDOFF_28", "o.o_orderkey % 4 <= 2"),
    ("LOG_7", "o.o_orderkey % 5 <= 1"),
    ("LOG_28", "o.o_orderkey % 5 <= 3"),
    ("ORDER_7", "o.o_orderkey % 6 = 0"),
    ("ORDER_28", "o.o_orderkey % 3 = 0"),
]
_ELC_AVGS = [("AVG_DIAS_HANDOFF", 28), ("AVG_DIAS_LOG", 21), ("AVG_DIAS_ORDER", 14)]

CTES["elc_cell"] = (
    f"SELECT {wk('o.o_orderdate')} AS week, c.c_nationkey, c.c_mktsegment,\n"
    + ",\n".join(f'  CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS DOUBLE) AS "{name}"'
                 for name, cond in _ELC_COUNTS)
    + ",\n"
    + ",\n".join(f'  floor(avg(o.o_orderkey % {m}) * 4) / 4 AS "{name}"' for name, m in _ELC_AVGS)
    + "\nFROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2, 3")

_ELC_TYPES = [n for n, _ in _ELC_COUNTS] + ["TOTAL AVAILABLE", "TOTAL ACTIVE"] + [n for n, _ in _ELC_AVGS]

CTES["elc_stock"] = """
SELECT *,
  SUM("AVAILABLE") OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY week
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS "TOTAL AVAILABLE",
  SUM("ACTIVE") OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY week
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS "TOTAL ACTIVE"
FROM elc_cell"""

CTES["elc_funnel"] = (
    f"SELECT {qlabel('u.week')} AS q, u.week, n.n_name AS country,\n"
    "  CASE u.c_mktsegment WHEN 'AUTOMOBILE' THEN 'HUNTING' WHEN 'BUILDING' THEN 'INSIDE SALES'\n"
    "    WHEN 'FURNITURE' THEN 'INSIDE SALES' WHEN 'HOUSEHOLD' THEN 'SELF-ONBOARDING'\n"
    "    WHEN 'MACHINERY' THEN 'BRAND EXPANSION' END AS team,\n"
    "  CASE u.c_mktsegment WHEN 'AUTOMOBILE' THEN 'HUNTING' WHEN 'BUILDING' THEN 'INSIDE SALES OUTBOUND'\n"
    "    WHEN 'FURNITURE' THEN 'INSIDE SALES INBOUND' WHEN 'HOUSEHOLD' THEN 'SELF-ONBOARDING'\n"
    "    WHEN 'MACHINERY' THEN 'BRAND EXPANSION' END AS channel_group,\n"
    "  u.type, CAST(u.metric AS DOUBLE) AS metric\n"
    "FROM (UNPIVOT elc_stock ON " + ", ".join(f'"{t}"' for t in _ELC_TYPES)
    + " INTO NAME type VALUE metric) u\n"
    "JOIN nation n ON u.c_nationkey = n.n_nationkey\n"
    "WHERE u.type NOT IN (" + ", ".join(f"'{n}'" for n, _ in _ELC_COUNTS) + ") OR u.metric <> 0")

CTES["elc_target"] = f"""
SELECT {qlabel('g.week')} AS q, g.week, n.n_name AS country, ch.team, ch.channel_group, k.tipo_target,
       CAST(CASE k.tipo_target WHEN 'AVAILABLE' THEN 1 + (g.nk + ch.c + weekofyear(g.week)) % 4
                 ELSE (g.nk + 2 * ch.c + weekofyear(g.week)) % 3 END AS DOUBLE) AS target
FROM (SELECT DISTINCT sw.week, s.s_nationkey AS nk
      FROM (SELECT DISTINCT l_suppkey, {wk('day')} AS week FROM supplier_day) sw
      JOIN supplier s ON sw.l_suppkey = s.s_suppkey) g
JOIN nation n ON g.nk = n.n_nationkey,
(VALUES (0, 'HUNTING', 'HUNTING'), (1, 'INSIDE SALES', 'INSIDE SALES OUTBOUND'),
        (2, 'INSIDE SALES', 'INSIDE SALES INBOUND'), (3, 'SELF-ONBOARDING', 'SELF-ONBOARDING'),
        (4, 'BRAND EXPANSION', 'BRAND EXPANSION')) ch(c, team, channel_group),
(VALUES ('AVAILABLE'), ('ACTIVE')) k(tipo_target)"""

CTES["churn_detail"] = f"""
SELECT a.week,
  CASE WHEN a.c_nationkey = 3 THEN 'BR' WHEN a.c_nationkey = 24 THEN NULL ELSE n.n_name END AS country,
  CASE a.o_orderstatus WHEN 'F' THEN 'M1' WHEN 'O' THEN 'M2' WHEN 'P' THEN 'M3' END AS age,
  CASE a.c_mktsegment WHEN 'AUTOMOBILE' THEN 'Hunting' WHEN 'BUILDING' THEN 'Inside Sales'
    WHEN 'FURNITURE' THEN 'Brand Expansion' WHEN 'HOUSEHOLD' THEN 'Self-Onboarding'
    WHEN 'MACHINERY' THEN 'Partners' END AS channel_am,
  a.churn, a.total_store
FROM (SELECT {wk('o.o_orderdate')} AS week, c.c_nationkey, o.o_orderstatus, c.c_mktsegment,
             CAST(SUM(CASE WHEN o.o_totalprice < 50000 THEN 1 ELSE 0 END) AS BIGINT) AS churn,
             CAST(COUNT(*) AS BIGINT) AS total_store
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2, 3, 4) a
JOIN nation n ON a.c_nationkey = n.n_nationkey"""

CTES["churn_target"] = f"""
SELECT strftime(week, '%Y-%m-%d') AS week, country, channel_am,
  CASE WHEN c = 4 AND w % 10 = 7 THEN CAST(0.75 AS DOUBLE)
       ELSE CAST((w * 3 + c * 5) % 64 + 32 AS DOUBLE) / 1024.0 END + off AS "TARGET_%CHURN_M1",
  CAST((w * 5 + c * 3) % 64 + 40 AS DOUBLE) / 1024.0 + off AS "TARGET_%CHURN_M2",
  CAST((w * 7 + c) % 64 + 48 AS DOUBLE) / 1024.0 + off AS "TARGET_%CHURN_M3"
FROM (SELECT week, weekofyear(week) AS w FROM (SELECT DISTINCT {wk('o_orderdate')} AS week FROM orders)) wk,
     (VALUES (1, 'HUNTING'), (2, 'IS'), (3, 'SOB'), (4, 'BE'), (5, 'TOTAL')) ch(c, channel_am),
     (VALUES ('TOTAL', CAST(0.0 AS DOUBLE)), ('CO', CAST(0.5 AS DOUBLE))) co(country, off)
WHERE (w + c) % 9 <> 0"""

CTES["store_detail"] = """
SELECT c.c_custkey AS store_id, n.n_name AS hunter_, r.r_name AS coordinador, c.c_mktsegment AS channel,
  'L' || CAST(c.c_custkey % 50 AS VARCHAR) AS razon_social,
  'B' || CAST(c.c_custkey % 20 AS VARCHAR) AS brand_name,
  'A' || CAST(c.c_custkey % 200 AS VARCHAR) AS adress,
  CAST((c.c_custkey * 37) % 101 AS DOUBLE) / 100.0 AS av_0_28,
  CAST((c.c_custkey * 41) % 101 AS DOUBLE) / 100.0 AS av_last_week,
  CAST((c.c_custkey * 43) % 101 AS DOUBLE) / 100.0 AS av_last_2week,
  CAST((c.c_custkey * 47) % 101 AS DOUBLE) / 100.0 AS av_l4w,
  COALESCE(p.n_partner, 0) AS orders_cancel_partner_0_28,
  COALESCE(p.n_done, 0) AS orders_0_28,
  CASE WHEN p.n_done > 0 THEN 'COMPLETED' ELSE 'PENDING' END AS handoff,
  COALESCE(p.first_order, DATE '1995-01-01') AS fecha_envio_de_credenciales,
  CASE WHEN c.c_acctbal < 0 THEN NULL
       ELSE COALESCE(p.first_order, DATE '1995-01-01') + CAST(c.c_custkey % 3 AS INTEGER) END AS first_login
FROM customer c
LEFT JOIN (SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS first_order,
                  CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_done,
                  CAST(SUM(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS n_partner
           FROM orders GROUP BY 1) p ON c.c_custkey = p.o_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey"""

CTES["store_history"] = f"""
SELECT o_custkey AS external_store_id, CAST(o_orderdate AS DATE) AS day_date,
       {wk('o_orderdate')} AS week_date, o_orderkey AS order_id, o_orderstatus AS status,
       o_totalprice AS order_value
FROM orders"""

CTES["store_snapshot"] = """
SELECT l_suppkey AS store_id, CAST(l_shipdate AS DATE) AS day,
       CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + to_days(CAST(l_partkey % 30 AS INTEGER)) + to_minutes(CAST(l_orderkey % 1440 AS INTEGER)) AS loaded_at,
       l_orderkey * 8 + l_linenumber AS load_id, CAST(l_quantity AS DOUBLE) AS stock, l_linestatus AS status
FROM lineitem"""

_NAME_RE = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def _deps(name: str) -> list[str]:
    return [t for t in dict.fromkeys(_NAME_RE.findall(CTES[name])) if t in CTES and t != name]


def with_tables(body: str, extra: dict[str, str] | None = None, once: bool = False) -> str:
    """Prefix ``body`` with the model-table CTEs it references (and the
    extra named CTEs given, which may reference model tables). ``once``:
    every CTE is evaluated a single time, however often it is named."""
    extra = extra or {}
    order: list[str] = []

    def visit(n: str, seen: tuple = ()):
        if n in order or n in seen:
            return
        for d in _deps(n):
            visit(d, seen + (n,))
        order.append(n)

    text = body + " ".join(extra.values())
    for n in dict.fromkeys(_NAME_RE.findall(text)):
        if n in CTES:
            visit(n)
    how = "AS MATERIALIZED" if once else "AS"
    parts = [f"{n} {how} ({CTES[n]}\n)" for n in order] + [f"{k} {how} ({v}\n)" for k, v in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body


def rha(expr: str, n: int) -> str:
    """SQL text of round-half-away-from-zero (same arithmetic as
    ``tallyspark.functions.exprs.round_half_away``)."""
    s = float(10**n)
    x = f"round({expr}, 9)"
    return f"(sign({x}) * floor(abs({x}) * {s!r} + 0.5) / {s!r} + 0.0)"


def aging_norm_sql(col: str) -> str:
    return (f"UPPER(TRIM(CASE {col} WHEN 'New Entry' THEN '01 - new entry' WHEN 'Junior' THEN '02 - junior' "
            f"WHEN 'Senior' THEN '03 - senior' END))")


def prefixed(ctes: dict[str, str], prefix: str, body: str | None = None):
    """Rename a CTE set (names and references) so several sets can share
    one statement; also rewrites ``body`` when given."""
    def ren(text):
        for name in ctes:
            text = re.sub(rf"\b{name}\b", prefix + name, text)
        return text
    out = {prefix + k: ren(v) for k, v in ctes.items()}
    return out if body is None else (ren(body), out)
