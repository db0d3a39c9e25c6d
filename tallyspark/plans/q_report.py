"""Registered queries: spec-driven report assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.operators import calendar as C
from tallyspark.operators import churn as CH
from tallyspark.operators import kpi as K
from tallyspark.operators import report as R
from tallyspark.plans.common import AS_OF, TZ, round_doubles
from tallyspark.plans.oracle_lines import report_lines
from tallyspark.plans.oracle_tables import aging_norm_sql, prefixed, rha, with_tables
from tallyspark.plans.q_churn import _CHURN_CTES
from tallyspark.plans.q_kpi import section_parts
from tallyspark.plans.registry import query
from tallyspark.session import stored
from tallyspark.sources import model as TD

SPEC = R.report_spec()


# -------------------------------------------------------------- Spark side
def _sections(spark, d):
    """The frames of all sections. What several of them read is reduced and stored first, so every table is read once."""
    full_target = TD.elc_target(spark, d)
    elc, etg = (stored(df, "report-part") for df in K.by_channel(TD.elc_funnel(spark, d), full_target))
    inside = stored(K.rep_weekly(TD.is_funnel(spark, d), TD.is_target(spark, d), by_project=True), "report-part")
    reps = {p: inside.where(F.col("proyecto") == p).drop("proyecto") for p in ("OUTBOUND", "INBOUND")}
    churn = CH.early_churn(TD.churn_detail(spark, d), TD.churn_target(spark, d), C.week_axis(etg), AS_OF, TZ)
    sections = {
        "main_metrics_top": K.main_metrics_top(elc),
        "main_metrics_bottom": K.main_metrics_bottom(elc),
        "hunting": K.rep_channel_section(elc, etg, K.rep_weekly(TD.ht_funnel(spark, d), TD.ht_target(spark, d)), "HUNTING", "HUNTING"),
        "inside_sales_outbound": K.rep_channel_section(elc, etg, reps["OUTBOUND"], "INSIDE SALES", "INSIDE SALES OUTBOUND"),
        "inside_sales_inbound": K.rep_channel_section(elc, etg, reps["INBOUND"], "INSIDE SALES", "INSIDE SALES INBOUND"),
        "self_onboarding": K.simple_channel_section(elc, etg, "SELF-ONBOARDING", "SELF-ONBOARDING", False),
        "brand_expansion": K.simple_channel_section(elc, etg, "BRAND EXPANSION", "BRAND EXPANSION", True),
        "early_churn_m1": churn, "early_churn_m2": churn, "early_churn_m3": churn,
    }
    # A frame has a row per week and channel. Read from its few files, its unpivoting needs one task, not one per shuffle
    # partition of each frame in one stage, where every task reports the metrics of all frames to the driver.
    kept = {id(f): stored(f, "report-section") for f in {id(f): f for f in sections.values()}.values()}
    return {name: kept[id(f)] for name, f in sections.items()}


# One report run = every section computed once, unpivoted into the long
# table; all report pieces (axis, QTD, GAP, cards, ...) are computed from
# it, as the business report is assembled from one run of its section
# queries. The long table is kept for the application that made it, never
# the answers; a lost executor re-reads files instead of recomputing it.
from tallyspark.sources import model as _model  # noqa: E402


def _long(spark, d):
    return _model.derived(spark, d, "report_long", lambda: R.values_long(_sections(spark, d), SPEC),
                          ("q", "section_id", "label", "week"))


def _axis(spark, d):
    return C.week_axis(TD.elc_target(spark, d))


def _rows(spark, d):
    return R.report_rows(_long(spark, d), _axis(spark, d), R.spec_frame(spark, SPEC), SPEC)


# ---------------------------------------------------------------- SQL side
def _lit(s) -> str:
    if s is None:
        return "NULL"
    if isinstance(s, bool):
        return "TRUE" if s else "FALSE"
    if isinstance(s, int):
        return str(s)
    return "'" + str(s).replace("'", "''") + "'"


def _sum_t(t: str) -> str:
    return f"SUM(CASE WHEN type = '{t}' THEN metric ELSE 0 END)"


def _report_ctes() -> dict[str, str]:
    ctes: dict[str, str] = {
        "mmt": f"""
SELECT q, week, total_available_stores, total_active_stores,
       new_active / NULLIF(new_available, 0) AS activation_rate_pct,
       total_available_stores - LAG(total_available_stores) OVER (PARTITION BY q ORDER BY week) AS net_available_adds,
       total_active_stores - LAG(total_active_stores) OVER (PARTITION BY q ORDER BY week) AS net_active_adds,
       new_available, new_active
FROM (SELECT q, week, {_sum_t('TOTAL AVAILABLE')} AS total_available_stores,
             {_sum_t('TOTAL ACTIVE')} AS total_active_stores, {_sum_t('AVAILABLE')} AS new_available,
             {_sum_t('ACTIVE')} AS new_active
      FROM elc_funnel WHERE type IN ('TOTAL AVAILABLE', 'TOTAL ACTIVE', 'AVAILABLE', 'ACTIVE') GROUP BY q, week)""",
        "mmb": f"""
SELECT q, week, new_available_stores, new_active_stores,
       new_active_stores / NULLIF(new_available_stores, 0) AS new_inflow_active_rate_pct
FROM (SELECT q, week, {_sum_t('AVAILABLE')} AS new_available_stores, {_sum_t('ACTIVE')} AS new_active_stores
      FROM elc_funnel WHERE type IN ('AVAILABLE', 'ACTIVE') GROUP BY q, week)""",
    }
    frames = {"main_metrics_top": "mmt", "main_metrics_bottom": "mmb"}
    for sid, pre, args in [("hunting", "h_", ("HUNTING", "HUNTING", "ht_funnel", "ht_target", None)),
                           ("inside_sales_outbound", "o_",
                            ("INSIDE SALES", "INSIDE SALES OUTBOUND", "is_funnel", "is_target", "OUTBOUND")),
                           ("inside_sales_inbound", "i_",
                            ("INSIDE SALES", "INSIDE SALES INBOUND", "is_funnel", "is_target", "INBOUND"))]:
        body, extra = section_parts(*args, raw=True)
        body, extra = prefixed(extra, pre, body)
        ctes.update(extra)
        ctes[pre + "sec"] = body
        frames[sid] = pre + "sec"
    for sid, team, created in [("self_onboarding", "SELF-ONBOARDING", False),
                               ("brand_expansion", "BRAND EXPANSION", True)]:
        types = "('AVAILABLE', 'CREATED')" if created else "('AVAILABLE')"
        cr = f", {_sum_t('CREATED')} AS store_created" if created else ""
        ctes[sid] = f"""
SELECT COALESCE(a.q, t.q) AS q, COALESCE(a.week, t.week) AS week, a.new_available, t.target_new_available
       {', a.store_created' if created else ''}
FROM (SELECT q, week, {_sum_t('AVAILABLE')} AS new_available{cr} FROM elc_funnel
      WHERE team = '{team}' AND channel_group = '{team}' AND type IN {types} GROUP BY q, week) a
FULL OUTER JOIN (SELECT q, week, SUM(target) AS target_new_available FROM elc_target
                 WHERE team = '{team}' AND channel_group = '{team}' AND tipo_target = 'AVAILABLE'
                 GROUP BY q, week) t ON a.q = t.q AND a.week = t.week"""
        frames[sid] = sid
    ctes.update(_CHURN_CTES)
    for age in ("m1", "m2", "m3"):
        frames[f"early_churn_{age}"] = "early"
    parts, lines = [], report_lines()
    for ln in lines:
        if ln["value"] is None:
            continue
        num, den = (f"CAST({ln[k] or 'NULL'} AS DOUBLE)" for k in ("num", "den"))
        where = f"age = '{ln['section_id'][-2:].upper()}' AND canal = '{ln['channel']}'" if ln["channel"] else "TRUE"
        parts.append(f"SELECT q, {_lit(ln['section_id'])} AS section_id, {_lit(ln['label'])} AS label, week, "
                     f"CAST({ln['value']} AS DOUBLE) AS value, {num} AS num, {den} AS den FROM {frames[ln['section_id']]} WHERE {where}")
    ctes["long"] = "\nUNION ALL ".join(parts)
    cols = ("section_id", "seq", "label", "format", "qtd_rule", "gap_against", "render_as", "invert_gap", "is_churn_total")
    ctes["spec"] = ("SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(_lit(ln[c]) for c in cols) + ")" for ln in lines)
                    + f") v({', '.join(cols)})")
    ctes["axis_all"] = "SELECT DISTINCT q, week FROM elc_target"
    ctes["lv"] = """
SELECT l.*, s.qtd_rule, s.gap_against FROM long l JOIN spec s ON l.section_id = s.section_id AND l.label = s.label
WHERE s.gap_against IS NULL
   OR EXISTS (SELECT 1 FROM long a WHERE a.q = l.q AND a.section_id = l.section_id AND a.label = s.gap_against
              AND a.week = l.week AND a.value IS NOT NULL)"""
    ctes["qtd"] = """
SELECT q, section_id, label, qtd_rule,
  CASE WHEN qtd_rule = 'additive' THEN SUM(value) WHEN qtd_rule = 'avg' THEN AVG(value)
       WHEN qtd_rule = 'last_value' THEN arg_max(value, CASE WHEN value IS NOT NULL THEN week END)
       WHEN qtd_rule IN ('weighted_ratio', 'weighted_productivity', 'funnel_ratio_qtd')
       THEN SUM(num) / NULLIF(SUM(den), 0) END AS qtd,
  COUNT(value) AS weeks_with_value
FROM lv GROUP BY q, section_id, label, qtd_rule"""
    ctes["gap"] = """
SELECT t.q, t.section_id, t.label, s.gap_against, a.qtd AS qtd_actual, t.qtd AS qtd_target, a.qtd - t.qtd AS gap
FROM qtd t JOIN spec s ON t.section_id = s.section_id AND t.label = s.label AND s.gap_against IS NOT NULL
LEFT JOIN qtd a ON a.q = t.q AND a.section_id = t.section_id AND a.label = s.gap_against"""
    ctes["rows"] = """
SELECT x.q, s.section_id, s.seq, s.label, s.format, s.qtd_rule, s.gap_against, s.invert_gap, s.is_churn_total,
       CASE s.render_as WHEN 'missing_source' THEN 'N/A' WHEN 'pending_definition' THEN 'Pending definition'
            ELSE 'value' END AS state,
       d.qtd, g.gap, CAST(COALESCE(d.weeks_with_value, 0) AS BIGINT) AS weeks_with_value
FROM (SELECT DISTINCT q FROM axis_all) x CROSS JOIN spec s
LEFT JOIN qtd d ON d.q = x.q AND d.section_id = s.section_id AND d.label = s.label
LEFT JOIN gap g ON g.q = x.q AND g.section_id = s.section_id AND g.label = s.label"""
    return ctes


_CTES = _report_ctes()


def _sql(body: str) -> str:
    return with_tables(body, extra=_CTES, once=True)


def _r6(cols):
    return ", ".join(f"{rha(c, 6)} AS {c.split('.')[-1]}" for c in cols)


# ------------------------------------------------------------------ queries
@query("section_on_axis", _sql(f"""
SELECT x.q, s.section_id, s.seq, s.label, x.week,
       {rha('CASE WHEN s.render_as IS NULL THEN l.value END', 6)} AS value,
       CASE s.render_as WHEN 'missing_source' THEN 'N/A' WHEN 'pending_definition' THEN 'Pending definition'
            ELSE 'value' END AS state
FROM axis_all x CROSS JOIN spec s
LEFT JOIN long l ON l.q = x.q AND l.section_id = s.section_id AND l.label = s.label AND l.week = x.week"""))
def section_on_axis(spark, d):
    return round_doubles(R.section_on_axis(_long(spark, d), _axis(spark, d), SPEC))


@query("qtd", _sql(f"SELECT q, section_id, label, qtd_rule, {rha('qtd', 6)} AS qtd, weeks_with_value FROM qtd"))
def qtd(spark, d):
    return round_doubles(R.qtd(_long(spark, d), R.spec_frame(spark, SPEC)))


@query("gap", _sql(f"SELECT q, section_id, label, gap_against, {_r6(['qtd_actual', 'qtd_target', 'gap'])} FROM gap"))
def gap(spark, d):
    return round_doubles(R.gap(_long(spark, d), R.spec_frame(spark, SPEC)))


@query("row_state", _sql(f"""
SELECT q, section_id, seq, label, format, qtd_rule, gap_against, invert_gap, is_churn_total, state,
       {_r6(['qtd', 'gap'])}, weeks_with_value FROM rows"""))
def row_state(spark, d):
    return round_doubles(_rows(spark, d))


@query("row_class", _sql(f"""
SELECT q, section_id, seq, label,
       (label LIKE 'Target%' OR label LIKE '%\\% Target%' ESCAPE '\\') AS is_target,
       ((label LIKE 'Target%' OR label LIKE '%\\% Target%' ESCAPE '\\')
        AND section_id IN ('hunting', 'inside_sales_outbound', 'inside_sales_inbound')
        AND (label LIKE '%Store\\_Created' ESCAPE '\\' OR label LIKE '%Productivity')) AS is_calculated,
       is_churn_total AS is_total,
       CASE WHEN invert_gap THEN 'lower_is_better' ELSE 'higher_is_better' END AS polarity,
       {rha('gap', 6)} AS gap,
       CASE WHEN gap IS NULL THEN NULL WHEN invert_gap THEN gap <= 0 ELSE gap >= 0 END AS gap_is_good
FROM rows"""))
def row_class(spark, d):
    return round_doubles(R.row_class(_rows(spark, d)))


def _shown(value: str) -> str:
    return f"""CASE WHEN state <> 'value' THEN state WHEN {value} IS NULL THEN '—'
      WHEN format = 'integer' THEN format('{{:,}}', CAST({rha(value, 0)} AS BIGINT))
      WHEN format = 'percent' THEN format('{{:,.2f}}%', {rha(f'{value} * 100', 2)}) ELSE format('{{:,.2f}}', {rha(value, 2)}) END"""


@query("display_cells", _sql(f"""
SELECT q, section_id, seq, label, strftime(week, '%Y-%m-%d') AS cell, {_shown('value')} AS display
FROM (SELECT x.q, s.section_id, s.seq, s.label, x.week, s.format, l.value,
             CASE s.render_as WHEN 'missing_source' THEN 'N/A' WHEN 'pending_definition' THEN 'Pending definition' ELSE 'value' END AS state
      FROM axis_all x CROSS JOIN spec s
      LEFT JOIN long l ON l.q = x.q AND l.section_id = s.section_id AND l.label = s.label AND l.week = x.week)
UNION ALL SELECT q, section_id, seq, label, 'QTD', {_shown('qtd')} FROM rows
UNION ALL SELECT q, section_id, seq, label, 'GAP', CASE WHEN state = 'value' AND gap > 0 THEN '+' ELSE '' END || {_shown('gap')} FROM rows"""))
def display_cells(spark, d):
    """Weekly, QTD and GAP cells of every line."""
    return R.display_cells(R.section_on_axis(_long(spark, d), _axis(spark, d), SPEC), R.spec_frame(spark, SPEC), _rows(spark, d))


@query("coverage", _sql("""
SELECT x.q, a.actuals_loaded_through, CAST(COALESCE(a.weeks_with_actual, 0) AS BIGINT) AS weeks_with_actual,
       x.weeks_in_axis
FROM (SELECT q, COUNT(DISTINCT week) AS weeks_in_axis FROM axis_all GROUP BY q) x
LEFT JOIN (SELECT q, MAX(week) AS actuals_loaded_through, COUNT(DISTINCT week) AS weeks_with_actual
           FROM long WHERE section_id = 'main_metrics_top' AND value IS NOT NULL GROUP BY q) a ON x.q = a.q"""))
def coverage(spark, d):
    return R.coverage(_long(spark, d), _axis(spark, d))


@query("summary_cards", _sql(f"""
SELECT q, 'available_qtd' AS card, section_id, label, {rha('qtd', 6)} AS value FROM rows
WHERE section_id = 'main_metrics_top' AND label = 'Total Available Stores'
UNION ALL SELECT q, 'active_qtd', section_id, label, {rha('qtd', 6)} FROM rows
WHERE section_id = 'main_metrics_top' AND label = 'Total Active Stores'
UNION ALL SELECT q, 'activation_rate_qtd', section_id, label, {rha('qtd', 6)} FROM rows
WHERE section_id = 'main_metrics_top' AND label = '% Activation Rate'
UNION ALL SELECT q, 'worst_gap', section_id, first(label ORDER BY gap, label), {rha('MIN(gap)', 6)} FROM rows
WHERE section_id IN ('hunting', 'inside_sales_outbound', 'inside_sales_inbound', 'self_onboarding',
                     'brand_expansion') AND gap < 0
GROUP BY q, section_id"""))
def summary_cards(spark, d):
    return round_doubles(R.summary_cards(_rows(spark, d)))


@query("top_gaps", _sql(f"""
SELECT q, rk AS rank, section_id, label, {rha('gap', 6)} AS gap FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY q ORDER BY ABS(gap) DESC, section_id, label) AS rk
  FROM rows WHERE gap IS NOT NULL) WHERE rk <= 5"""))
def top_gaps(spark, d):
    return round_doubles(R.top_gaps(_rows(spark, d), 5)).withColumn("rank", F.col("rank").cast("bigint"))


@query("section_status", _sql(f"""
SELECT q, section_id, label AS main_kpi, {rha('gap', 6)} AS gap, {rha('rel', 6)} AS relative_gap,
       CASE WHEN rel IS NULL THEN NULL WHEN rel >= -0.05 THEN 'on_track' WHEN rel >= -0.15 THEN 'risk'
            ELSE 'critical' END AS status
FROM (SELECT q, section_id, label, gap,
             CASE WHEN invert_gap THEN -1 ELSE 1 END * (gap / NULLIF(ABS(qtd), 0)) AS rel
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY q, section_id ORDER BY seq) AS rn
            FROM rows WHERE gap IS NOT NULL) WHERE rn = 1)"""))
def section_status(spark, d):
    return round_doubles(R.section_status(_rows(spark, d)))


@query("kpi_trend", _sql(f"""
SELECT l.q, l.section_id, l.label, l.n_weeks, {rha('l.v_first', 6)} AS v_first, {rha('l.v_last', 6)} AS v_last,
  CASE WHEN l.n_weeks < 2 THEN NULL WHEN ABS(l.v_last - l.v_first) <= ABS(l.v_first) * 0.01 THEN 'stable'
       WHEN CASE WHEN s.invert_gap THEN -(l.v_last - l.v_first) ELSE l.v_last - l.v_first END > 0 THEN 'improving'
       ELSE 'worsening' END AS trend
FROM (SELECT q, section_id, label, MAX(CASE WHEN rn = 1 THEN value END) AS v_last,
             arg_max(value, rn) AS v_first, MAX(rn) AS n_weeks
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY q, section_id, label ORDER BY week DESC) AS rn
            FROM long WHERE value IS NOT NULL) WHERE rn <= 3 GROUP BY q, section_id, label) l
JOIN spec s ON s.section_id = l.section_id AND s.label = l.label"""))
def kpi_trend(spark, d):
    out = R.kpi_trend(_long(spark, d), R.spec_frame(spark, SPEC))
    return round_doubles(out).withColumn("n_weeks", F.col("n_weeks").cast("bigint"))


@query("kpi_pull", _sql(f"""
SELECT q, section_id, label, {rha('gap', 6)} AS gap, {rha('ABS(gap) / NULLIF(ABS(qtd), 0)', 6)} AS pull,
       ROW_NUMBER() OVER (PARTITION BY q, section_id
                          ORDER BY {rha('ABS(gap) / NULLIF(ABS(qtd), 0)', 6)} DESC NULLS LAST, label) AS pull_rank
FROM rows WHERE gap IS NOT NULL"""))
def kpi_pull(spark, d):
    return round_doubles(R.kpi_pull(_rows(spark, d))).withColumn("pull_rank", F.col("pull_rank").cast("bigint"))


def _dec(expr: str) -> str:
    return f"CAST({rha(expr, 6)} AS DECIMAL(38, 6))"


@query("report_json", _sql(f"""
SELECT r.q, r.section_id, r.seq, r.label, CAST(to_json({{'section': r.section_id, 'label': r.label, 'format': r.format,
       'state': CASE WHEN r.state <> 'value' THEN r.state END,
       'weeks': CASE WHEN r.state = 'value' THEN w.weeks END, 'qtd': {_dec('r.qtd')}, 'gap': {_dec('r.gap')}}}) AS VARCHAR) AS json
FROM rows r JOIN (
  SELECT x.q, s.section_id, s.label, list({{'week': strftime(x.week, '%Y-%m-%d'), 'value': {_dec('l.value')}}} ORDER BY x.week) AS weeks
  FROM axis_all x CROSS JOIN spec s
  LEFT JOIN long l ON l.q = x.q AND l.section_id = s.section_id AND l.label = s.label AND l.week = x.week
  GROUP BY ALL) w ON w.q = r.q AND w.section_id = r.section_id AND w.label = r.label"""))
def report_json(spark, d):
    long = _long(spark, d)
    return R.report_json(R.section_on_axis(long, _axis(spark, d), SPEC), _rows(spark, d))


# ------------------------------------------------------- gap concentration
@query("gap_concentration", with_tables(f"""
SELECT COALESCE(a.q, t.q) AS q, COALESCE(a.channel_group, t.channel_group) AS channel_group,
       COALESCE(a.country, t.country) AS country, COALESCE(a.actual, 0.0) AS actual, COALESCE(t.target, 0.0) AS target,
       COALESCE(a.actual, 0.0) - COALESCE(t.target, 0.0) AS gap,
       {rha("(COALESCE(a.actual, 0.0) - COALESCE(t.target, 0.0)) / NULLIF(SUM(COALESCE(a.actual, 0.0) - COALESCE(t.target, 0.0)) OVER (PARTITION BY COALESCE(a.q, t.q), COALESCE(a.channel_group, t.channel_group)), 0)", 6)} AS share
FROM (SELECT q, channel_group, country, SUM(metric) AS actual FROM elc_funnel WHERE type = 'AVAILABLE'
      GROUP BY q, channel_group, country) a
FULL OUTER JOIN (SELECT q, channel_group, country, SUM(target) AS target FROM elc_target t
                 WHERE tipo_target = 'AVAILABLE' AND EXISTS (
                   SELECT 1 FROM elc_funnel f WHERE f.type = 'AVAILABLE' AND f.q = t.q
                   AND f.channel_group = t.channel_group AND f.week = t.week)
                 GROUP BY q, channel_group, country) t
  ON a.q = t.q AND a.channel_group = t.channel_group AND a.country = t.country"""))
def gap_concentration(spark, d):
    return round_doubles(K.gap_concentration(TD.elc_funnel(spark, d), TD.elc_target(spark, d)),
                         skip=("actual", "target", "gap"))




def _parts_sql(channel: str, funnel: str, target: str, proj: str) -> str:
    key = f", {proj}" if proj else ""
    return f"""
SELECT f.q, {channel} AS channel, f.country, f.aging, f.stores AS actual, f.days * t.rate AS target
FROM (SELECT q, week_date AS week, country{key}, {aging_norm_sql('aging_category_final')} AS aging, SUM(stores_totales) AS stores,
             SUM(dias_trabajados) FILTER (WHERE hc = 1) AS days FROM {funnel} GROUP BY ALL) f
LEFT JOIN (SELECT q, week, country{key}, UPPER(TRIM(aging)) AS aging, AVG(target) AS rate FROM {target}
           WHERE tipo_target = 'PRODUCTIVIDAD' GROUP BY ALL) t
  ON f.q = t.q AND f.week = t.week AND f.country = t.country AND f.aging = t.aging{f" AND f.{proj} = t.{proj}" if proj else ""}"""


@query("gap_concentration_cube", with_tables(f"""
SELECT q, CASE GROUPING(channel, country, aging) WHEN 0 THEN 'channel+country+aging' WHEN 1 THEN 'channel+country' WHEN 2 THEN 'channel+aging'
       WHEN 3 THEN 'channel' WHEN 4 THEN 'country+aging' WHEN 5 THEN 'country' WHEN 6 THEN 'aging' ELSE 'total' END AS grain,
       channel, country, aging, CAST(COALESCE(SUM(actual), 0) AS DOUBLE) AS actual, COALESCE(SUM(target), 0) AS target,
       COALESCE(SUM(actual), 0) - COALESCE(SUM(target), 0) AS gap,
       {rha('(COALESCE(SUM(actual), 0) - COALESCE(SUM(target), 0)) / NULLIF(SUM(COALESCE(SUM(actual), 0) - COALESCE(SUM(target), 0)) OVER (PARTITION BY q, GROUPING(channel, country, aging)), 0)', 6)} AS share,
       ROW_NUMBER() OVER (PARTITION BY q, GROUPING(channel, country, aging)
         ORDER BY COALESCE(SUM(actual), 0) - COALESCE(SUM(target), 0), channel NULLS LAST, country NULLS LAST, aging NULLS LAST) AS rank
FROM parts GROUP BY GROUPING SETS ((q, channel, country, aging), (q, channel, country), (q, channel, aging), (q, country, aging),
                                   (q, channel), (q, country), (q, aging), (q))""", extra={
    "parts": _parts_sql("'HUNTING'", "ht_funnel", "ht_target", "") + " UNION ALL "
             + _parts_sql("'INSIDE SALES ' || f.proyecto", "is_funnel", "is_target", "proyecto")}))
def gap_concentration_cube(spark, d):
    parts = K.rep_gap_parts(TD.ht_funnel(spark, d), TD.ht_target(spark, d), TD.is_funnel(spark, d), TD.is_target(spark, d))
    return round_doubles(K.gap_cube(parts), skip=("actual", "target", "gap"))
