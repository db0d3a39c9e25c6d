"""Spec-driven weekly KPI report: rows on the quarter's week axis, QTD by
rule, GAP against the paired actual row, row states and classes, display
cells, coverage, summary cards, top gaps, section status, gap
concentration, trends, pull ranking and the JSON payload.

The report layout is a small *spec* (one row per KPI line). Its
expressions (field, numerator, denominator, row filter) are SQL expression
strings evaluated by Spark itself, so one spec drives every section.
Every section frame is unpivoted into one long table
(q, section_id, label, week, value, num, den); everything downstream is an
aggregation or a join of that table, whose size is weeks x KPI lines (the
report's own size, independent of the facts).
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.functions.exprs import round_half_away, safe_div


@dataclass(frozen=True)
class Line:
    section_id: str
    seq: int
    label: str
    field: str | None = None          # SQL expression over the section frame
    fmt: str = "integer"              # integer | number | percent
    qtd_rule: str | None = None       # additive | avg | weighted_ratio | weighted_productivity
    #                                   | funnel_ratio_qtd | last_value
    num: str | None = None            # numerator parts (ratio rules)
    den: str | None = None            # denominator parts
    gap_against: str | None = None    # label of the actual row this target is compared with
    render_as: str | None = None      # missing_source | pending_definition
    invert_gap: bool = False
    is_churn_total: bool = False
    row_filter: str | None = None     # SQL predicate selecting the frame rows of this line


# ---------------------------------------------------------------------------
# Fixed values of the report layout (labels as the business report shows them).
MAIN_TOP = [
    ("% Lead Penetration", None, "percent", None, None, None, "missing_source"),
    ("Total Available Stores", "total_available_stores", "integer", "last_value", None, None, None),
    ("Net Available Adds", "net_available_adds", "integer", "additive", None, None, None),
    ("Total Active Stores", "total_active_stores", "integer", "last_value", None, None, None),
    ("% Activation Rate", "activation_rate_pct", "percent", "weighted_ratio", "new_active", "new_available", None),
    ("Net Active Adds", "net_active_adds", "integer", "additive", None, None, None),
]
MAIN_BOTTOM = [
    ("New Available Stores", "new_available_stores", "integer", "additive", None, None, None),
    ("New Active Stores", "new_active_stores", "integer", "additive", None, None, None),
    ("New Inflow Active Rate", "new_inflow_active_rate_pct", "percent", "weighted_ratio",
     "new_active_stores", "new_available_stores", None),
]
# Rep channel sections: (section_id, display name, name of the rep role in "% ... Old").
REP_SECTIONS = [("hunting", "Hunting", "Hunters"),
                ("inside_sales_outbound", "Inside Sales Outbound", "Agents"),
                ("inside_sales_inbound", "Inside Sales Inbound", "Agents")]
FUNNEL_LINES = [
    ("% Handoff done <= 3 days", "pct_handoff_3d", "handoff_3"),
    ("% Handoff / Signings (Closed cohort) - 7D", "pct_handoff_7d", "handoff_7"),
    ("% First_Log_in rate (Closed cohort) - 7D", "pct_login_7d", "log_7"),
]
AVG_LINES = [("Avg days from Signing to Handoff", "avg_dias_handoff"),
             ("Avg days from Signing to Log_in", "avg_dias_log"),
             ("Avg days from Log_in to First_Order", "avg_dias_order")]
FUNNEL_LINES_28 = [
    ("% Handoff / Signings (Closed cohort) - 28D", "pct_handoff_28d", "handoff_28"),
    ("% First_Log_in rate (Closed cohort) - 28D", "pct_login_28d", "log_28"),
    ("% First_order rate (Closed cohort)", "pct_first_order", "order_28"),
]
# Lines of a rep section that have no source yet; they follow the stores target.
REP_SECTION_MISSING = {"inside_sales_inbound": ["Target Inbound Verified Leads"]}
SELF_ONBOARDING_MISSING = ["Total Self Onboarding Store_Created", "Target Self Onboarding Store_Created",
                           "VL Leads", "VL Leads Target"]
BRAND_EXPANSION_MISSING = ["Target Brand Expansion Store_Created", "% First_Log_in rate (Closed cohort)",
                           "% First_order rate (Closed cohort)"]
CHURN_CHANNELS = [("HUNTING", "Hunting"), ("IS", "Inside Sales"), ("SOB", "Self-Onboarding"),
                  ("BE", "Brand Expansion"), ("TOTAL", "Total")]
CHURN_AGES = ["M1", "M2", "M3"]
STATE_LABELS = {"missing_source": "N/A", "pending_definition": "Pending definition"}
# ---------------------------------------------------------------------------


def report_spec() -> list[Line]:
    """All report lines, in display order, built from the layout rules."""
    out: list[Line] = []

    def simple(section, rows):
        for i, (label, field, fmt, rule, num, den, render) in enumerate(rows, start=1):
            out.append(Line(section, i, label, field, fmt, rule, num, den, render_as=render))

    simple("main_metrics_top", MAIN_TOP)
    simple("main_metrics_bottom", MAIN_BOTTOM)
    for sid, name, role in REP_SECTIONS:
        rows = [
            Line(sid, 1, f"Total New Available Stores {name}", "new_available", "integer", "additive"),
            Line(sid, 2, f"Target Total New Available Stores {name}", "target_new_available", "integer",
                 "additive", gap_against=f"Total New Available Stores {name}"),
            Line(sid, 3, f"Total {name} Store_Created", "store_created", "integer", "additive"),
            Line(sid, 4, f"Target {name} Store_Created", "target_store_created", "number", "additive",
                 gap_against=f"Total {name} Store_Created"),
            Line(sid, 5, f"Total {name} Productivity", "productivity", "number", "weighted_productivity",
                 "stores_real", "dias_real"),
            Line(sid, 6, f"Target {name} Productivity", "target_productivity", "number", "weighted_productivity",
                 "target_store_created", "dias_trabajados_reales_total", gap_against=f"Total {name} Productivity"),
            Line(sid, 7, "% New Signings Perfect Stores", "pct_perfect_stores", "percent", "funnel_ratio_qtd",
                 "perfect_stores", "store_created"),
            Line(sid, 8, f"Total {name} Headcount", "headcount", "number", "avg"),
            Line(sid, 9, f"Target {name} Headcount", "target_headcount", "number", "avg",
                 gap_against=f"Total {name} Headcount"),
            Line(sid, 10, f"% {role} Old", "pct_old", "percent", "weighted_ratio", "senior_headcount", "headcount"),
            Line(sid, 11, f"% Target {role} Old", "pct_target_old", "percent", "weighted_ratio",
                 "target_senior_headcount", "target_headcount", gap_against=f"% {role} Old"),
        ]
        seq = 12
        for label, field, num in FUNNEL_LINES:
            rows.append(Line(sid, seq, label, field, "percent", "funnel_ratio_qtd", num, "store_created"))
            seq += 1
        for label, field in AVG_LINES:
            rows.append(Line(sid, seq, label, field, "number", "avg"))
            seq += 1
        for label, field, num in FUNNEL_LINES_28:
            rows.append(Line(sid, seq, label, field, "percent", "funnel_ratio_qtd", num, "store_created"))
            seq += 1
        rows[2:2] = [Line(sid, 3, label, render_as="missing_source") for label in REP_SECTION_MISSING.get(sid, [])]
        out.extend(replace(ln, seq=i) for i, ln in enumerate(rows, start=1))
    so = "self_onboarding"
    out.append(Line(so, 1, "Total New Available Stores Self Onboarding", "new_available", "integer", "additive"))
    out.append(Line(so, 2, "Target Total New Available Stores Self Onboarding", "target_new_available", "integer",
                    "additive", gap_against="Total New Available Stores Self Onboarding"))
    for i, label in enumerate(SELF_ONBOARDING_MISSING, start=3):
        out.append(Line(so, i, label, render_as="missing_source"))
    out.append(Line(so, 7, "Conv E2E", fmt="percent", render_as="pending_definition"))
    be = "brand_expansion"
    out.append(Line(be, 1, "Total New Available Stores Brand Expansion", "new_available", "integer", "additive"))
    out.append(Line(be, 2, "Target Total New Available Stores Brand Expansion", "target_new_available", "integer",
                    "additive", gap_against="Total New Available Stores Brand Expansion"))
    out.append(Line(be, 3, "Total Brand Expansion Store_Created", "store_created", "integer", "additive"))
    for i, label in enumerate(BRAND_EXPANSION_MISSING, start=4):
        out.append(Line(be, i, label, fmt="percent" if label.startswith("%") else "integer",
                        render_as="missing_source"))
    tnum = "CASE WHEN target_pct IS NOT NULL THEN target_pct * total_stores END"
    tden = "CASE WHEN target_pct IS NOT NULL THEN total_stores END"
    for age in CHURN_AGES:
        sid = f"early_churn_{age.lower()}"
        seq = 1
        for code, name in CHURN_CHANNELS:
            flt = f"age = '{age}' AND canal = '{code}'"
            total = code == "TOTAL"
            out.append(Line(sid, seq, f"% Churn {name}", "churn_pct", "percent", "weighted_ratio",
                            "churn_stores", "total_stores", is_churn_total=total, row_filter=flt))
            out.append(Line(sid, seq + 1, f"Target % Churn {name}", "target_pct", "percent", "weighted_ratio",
                            tnum, tden, gap_against=f"% Churn {name}", invert_gap=True, is_churn_total=total,
                            row_filter=flt))
            seq += 2
    return out


SPEC_SCHEMA = T.StructType([
    T.StructField("section_id", T.StringType()), T.StructField("seq", T.IntegerType()),
    T.StructField("label", T.StringType()), T.StructField("format", T.StringType()),
    T.StructField("qtd_rule", T.StringType()), T.StructField("gap_against", T.StringType()),
    T.StructField("render_as", T.StringType()), T.StructField("invert_gap", T.BooleanType()),
    T.StructField("is_churn_total", T.BooleanType())])


def spec_frame(spark: SparkSession, spec: list[Line] | None = None) -> DataFrame:
    """The spec as a DataFrame (about a hundred rows; broadcast on use)."""
    spec = spec or report_spec()
    rows = [(s.section_id, s.seq, s.label, s.fmt, s.qtd_rule, s.gap_against, s.render_as, s.invert_gap,
             s.is_churn_total) for s in spec]
    return spark.createDataFrame(rows, SPEC_SCHEMA)


def _spec_literal(spec: list[Line]):
    """The spec as an array literal (used to explode it onto the axis
    without a join)."""
    return F.array(*[F.struct(F.lit(s.section_id).alias("section_id"), F.lit(s.seq).alias("seq"),
                              F.lit(s.label).alias("label"), F.lit(s.render_as).cast("string").alias("render_as"))
                     for s in spec])


# --------------------------------------------------------------- long table
def section_long(frame: DataFrame, lines: list[Line]) -> DataFrame:
    """Unpivot one section frame into (q, section_id, label, week, value,
    num, den): one generator pass, no per-line scans."""
    lines = [ln for ln in lines if ln.field is not None]
    if not lines:
        return None
    e = lambda s: F.expr(s).cast("double") if s else F.lit(None).cast("double")
    structs = [F.struct(F.lit(ln.section_id).alias("section_id"), F.lit(ln.label).alias("label"),
                        e(ln.field).alias("value"), e(ln.num).alias("num"), e(ln.den).alias("den"),
                        (F.expr(ln.row_filter) if ln.row_filter else F.lit(True)).alias("keep"))
               for ln in lines]
    return (frame.select("q", "week", F.explode(F.array(*structs)).alias("x"))
            .where(F.col("x.keep"))
            .select("q", "x.section_id", "x.label", "week", "x.value", "x.num", "x.den"))


def values_long(sections: dict[str, DataFrame], spec: list[Line] | None = None) -> DataFrame:
    spec = spec or report_spec()
    # Sections on one frame are unpivoted together, so the frame is computed once.
    frames = {id(f): f for f in sections.values()}
    parts = [section_long(f, [ln for ln in spec if ln.section_id in sections and sections[ln.section_id] is f]) for f in frames.values()]
    return reduce(lambda a, b: a.unionByName(b), [p for p in parts if p is not None])


def section_on_axis(long: DataFrame, axis: DataFrame, spec: list[Line] | None = None) -> DataFrame:
    """Every report line on every week of the quarter's axis; NULL where no
    value exists (future weeks stay NULL, never 0); text state for lines
    without a source."""
    spec = spec or report_spec()
    grid = (axis.select("q", "week", F.explode(_spec_literal(spec)).alias("s"))
            .select("q", "week", "s.section_id", "s.seq", "s.label", "s.render_as"))
    j = grid.join(long.select("q", "section_id", "label", "week", "value"),
                  ["q", "section_id", "label", "week"], "left")
    state = F.coalesce(*[F.when(F.col("render_as") == k, F.lit(v)) for k, v in STATE_LABELS.items()],
                       F.lit("value"))
    return j.select("q", "section_id", "seq", "label", "week",
                    F.when(F.col("render_as").isNull(), F.col("value")).alias("value"), state.alias("state"))


# ---------------------------------------------------------------- QTD & GAP
def line_totals(long: DataFrame, spark_spec: DataFrame, grid: DataFrame | None = None) -> DataFrame:
    """QTD of every line by its rule, and beside it the QTD of the actual line
    it is compared with, in one pass and one shuffle.

    A target line and its actual line share a pair. Partitioned by (quarter,
    section, pair), a window over the pair's week marks the weeks in which the
    actual has a value (target lines count only these), one aggregation
    gives every line's QTD, and a window over the pair hands the actual's QTD
    to its target lines. ``grid`` (q, section_id, label) asks for its lines
    only, also those without rows: their QTD is NULL and they have no weeks."""
    spec = F.broadcast(spark_spec.select("section_id", "label", "qtd_rule", "gap_against"))
    rows = long.select("q", "section_id", "label", "week", "value", "num", "den", F.lit(True).alias("given"))
    if grid is not None:
        rows = rows.unionByName(grid.select("q", "section_id", "label", F.lit(False).alias("given")), allowMissingColumns=True)
    is_actual, has = F.col("gap_against").isNull(), F.col("value").isNotNull()
    lv = rows.join(spec, ["section_id", "label"]).withColumn("pair", F.coalesce("gap_against", "label"))
    lv = lv.repartition("q", "section_id", "pair")
    marked = F.max(F.when(is_actual & has, 1)).over(W.partitionBy("q", "section_id", "pair", "week"))
    lv = lv.withColumn("marked", marked).where(~F.col("given") | is_actual | F.col("marked").isNotNull())
    g = lv.groupBy("q", "section_id", "pair", "label", "qtd_rule", "gap_against").agg(
        F.sum("value").alias("sum_v"), F.avg("value").alias("avg_v"),
        F.max_by("value", F.when(has, F.col("week"))).alias("last_v"),
        F.sum("num").alias("sum_num"), F.sum("den").alias("sum_den"),
        F.count("value").alias("weeks_with_value"), F.min("given").alias("given"))
    rule = F.col("qtd_rule")
    value = (F.when(rule == "additive", F.col("sum_v")).when(rule == "avg", F.col("avg_v"))
             .when(rule == "last_value", F.col("last_v"))
             .when(rule.isin("weighted_ratio", "weighted_productivity", "funnel_ratio_qtd"),
                   safe_div("sum_num", "sum_den")))
    actual = F.max(F.when(is_actual, F.col("qtd"))).over(W.partitionBy("q", "section_id", "pair"))
    g = g.withColumn("qtd", value).withColumn("qtd_actual", F.when(~is_actual, actual))
    if grid is not None:
        g = g.where(~F.col("given"))
    return g.select("q", "section_id", "label", "qtd_rule", "gap_against", "qtd", "weeks_with_value", "qtd_actual",
                    (F.col("qtd_actual") - F.col("qtd")).alias("gap"))


def qtd(long: DataFrame, spark_spec: DataFrame) -> DataFrame:
    """QTD per line by its rule. Target lines only count the weeks in which
    their paired actual line has a value."""
    return line_totals(long, spark_spec).select("q", "section_id", "label", "qtd_rule", "qtd", "weeks_with_value")


def gap(long: DataFrame, spark_spec: DataFrame) -> DataFrame:
    """GAP = QTD actual - QTD target, on the target line; NULL without a
    target."""
    return line_totals(long, spark_spec).where(F.col("gap_against").isNotNull()).select(
        "q", "section_id", "label", "gap_against", "qtd_actual", F.col("qtd").alias("qtd_target"), "gap")


def report_rows(long: DataFrame, axis: DataFrame, spark_spec: DataFrame,
                spec: list[Line] | None = None) -> DataFrame:
    """One row per (quarter, line): spec attributes, state, QTD and GAP.
    Quarters come from the axis, so lines without data still appear.
    ``spec`` must be the lines ``spark_spec`` was built from."""
    # Every quarter gets every line: the spec (a fixed literal) is exploded
    # onto the distinct quarters, a generator rather than a join.
    grid = axis.select("q").distinct().select("q", F.explode(_spec_literal(spec or report_spec())).alias("s")).select("q", "s.*")
    state = F.coalesce(*[F.when(F.col("render_as") == k, F.lit(v)) for k, v in STATE_LABELS.items()],
                       F.lit("value"))
    rest = F.broadcast(spark_spec.select("section_id", "label", "seq", "format", "render_as", "invert_gap", "is_churn_total"))
    return line_totals(long, spark_spec, grid).join(rest, ["section_id", "label"]).select(
        "q", "section_id", "seq", "label", "format", "qtd_rule", "gap_against", "invert_gap",
        "is_churn_total", state.alias("state"), "qtd", "gap", F.col("weeks_with_value").cast("bigint").alias("weeks_with_value"))


REP_SECTION_IDS = {s for s, _, _ in REP_SECTIONS}


def row_class(rows: DataFrame) -> DataFrame:
    """Target / recalculated / total flags and polarity of every line, and
    whether its gap is good news given the polarity."""
    label = F.col("label")
    is_target = label.startswith("Target") | label.contains("% Target")
    is_calc = (is_target & F.col("section_id").isin(*REP_SECTION_IDS)
               & (label.endswith("Store_Created") | label.endswith("Productivity")))
    inverted = F.col("invert_gap")
    good = F.when(F.col("gap").isNull(), F.lit(None).cast("boolean")).when(
        inverted, F.col("gap") <= 0).otherwise(F.col("gap") >= 0)
    return rows.select("q", "section_id", "seq", "label", is_target.alias("is_target"),
                       is_calc.alias("is_calculated"), F.col("is_churn_total").alias("is_total"),
                       F.when(inverted, F.lit("lower_is_better")).otherwise(F.lit("higher_is_better"))
                       .alias("polarity"), "gap", good.alias("gap_is_good"))


def _fmt(value, fmt):
    v2 = round_half_away(value, 2)
    return (F.when(value.isNull(), F.lit("—"))
            .when(fmt == "integer", F.format_number(round_half_away(value, 0), 0))
            .when(fmt == "percent", F.concat(F.format_number(round_half_away(value * 100, 2), 2), F.lit("%")))
            .otherwise(F.format_number(v2, 2)))


def display_cells(on_axis: DataFrame, spark_spec: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Formatted cells, one per line and week (``cell`` is the ISO week) and,
    with ``rows`` (``report_rows``), the QTD and GAP cells: integer #,##0;
    number #,##0.00; percent 0.00%; a positive GAP with its sign; NULL -> em
    dash (never 0); lines without source show their state."""
    spec = F.broadcast(spark_spec.select("section_id", "label", "format"))
    j = on_axis.join(spec, ["section_id", "label"])

    def shown(value):
        return F.when(F.col("state") != "value", F.col("state")).otherwise(_fmt(value, F.col("format")))
    key = ["q", "section_id", "seq", "label"]
    out = j.select(*key, F.date_format("week", "yyyy-MM-dd").alias("cell"), shown(F.col("value")).alias("display"))
    if rows is None:
        return out
    signed = F.concat(F.when((F.col("state") == "value") & (F.col("gap") > 0), F.lit("+")).otherwise(F.lit("")), shown(F.col("gap")))
    both = F.inline(F.array(F.struct(F.lit("QTD").alias("cell"), shown(F.col("qtd")).alias("display")),
                            F.struct(F.lit("GAP").alias("cell"), signed.alias("display"))))
    return out.unionByName(rows.select(*key, both))


# ----------------------------------------------------- summaries and insight
def coverage(long: DataFrame, axis: DataFrame, section: str = "main_metrics_top") -> DataFrame:
    """Actuals loaded through (last week with any actual value), weeks with
    actuals and weeks on the axis, per quarter."""
    a = (long.where((F.col("section_id") == section) & F.col("value").isNotNull())
         .groupBy("q").agg(F.max("week").alias("actuals_loaded_through"),
                           F.countDistinct("week").alias("weeks_with_actual")))
    x = axis.groupBy("q").agg(F.countDistinct("week").alias("weeks_in_axis"))
    return x.join(a, "q", "left").select(
        "q", "actuals_loaded_through", F.coalesce("weeks_with_actual", F.lit(0)).cast("bigint").alias("weeks_with_actual"),
        "weeks_in_axis")


CARD_LINES = [("available_qtd", "Total Available Stores"), ("active_qtd", "Total Active Stores"),
              ("activation_rate_qtd", "% Activation Rate")]
CHANNEL_SECTIONS = ["hunting", "inside_sales_outbound", "inside_sales_inbound", "self_onboarding",
                    "brand_expansion"]


def summary_cards(rows: DataFrame) -> DataFrame:
    """Main-metric QTD cards and, per channel section, its most negative
    gap: (q, card, section_id, label, value), from one aggregation of the rows."""
    def card(name, when, value):
        return F.min(F.when(when, F.struct(F.lit(name).alias("card"), F.col(value).alias("value"), "label"))).alias(name)
    main = F.col("section_id") == "main_metrics_top"
    cards = [card(name, main & (F.col("label") == label), "qtd") for name, label in CARD_LINES]
    cards.append(card("worst_gap", F.col("section_id").isin(*CHANNEL_SECTIONS) & (F.col("gap") < 0), "gap"))
    names = [*[n for n, _ in CARD_LINES], "worst_gap"]
    g = rows.where(F.col("section_id").isin("main_metrics_top", *CHANNEL_SECTIONS)).groupBy("q", "section_id").agg(*cards)
    found = F.filter(F.array(*names), lambda x: x.isNotNull())
    return g.select("q", "section_id", F.explode(found).alias("c")).select("q", "c.card", "section_id", "c.label", "c.value")


def top_gaps(rows: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` largest gaps by magnitude per quarter (ties: section, label)."""
    w = W.partitionBy("q").orderBy(F.abs("gap").desc(), "section_id", "label")
    return (rows.where(F.col("gap").isNotNull()).withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k).select("q", "rank", "section_id", "label", "gap"))


def section_status(rows: DataFrame, on_track: float = 0.05, risk: float = 0.15) -> DataFrame:
    """Status of each section from its main KPI (first line with a gap):
    relative gap = gap / |target QTD| (sign flipped for inverted lines);
    >= -on_track -> on_track, >= -risk -> risk, else critical. The
    thresholds are parameters: the business rules do not state them."""
    g = rows.where(F.col("gap").isNotNull()).withColumn("target_qtd", F.col("qtd"))
    main = g.groupBy("q", "section_id").agg(F.min(F.struct("seq", "label", "gap", "target_qtd", "invert_gap"))
                                            .alias("m"))
    rel = safe_div(F.col("m.gap"), F.abs(F.col("m.target_qtd")))
    rel = F.when(F.col("m.invert_gap"), -rel).otherwise(rel)
    status = (F.when(rel.isNull(), F.lit(None).cast("string")).when(rel >= -on_track, F.lit("on_track"))
              .when(rel >= -risk, F.lit("risk")).otherwise(F.lit("critical")))
    return main.select("q", "section_id", F.col("m.label").alias("main_kpi"), F.col("m.gap").alias("gap"),
                       round_half_away(rel, 6).alias("relative_gap"), status.alias("status"))


def kpi_trend(long: DataFrame, spark_spec: DataFrame, tol: float = 0.01) -> DataFrame:
    """Direction over the last (up to) three weeks with a value: compare the
    latest value with the oldest of them; within ``tol`` relative -> stable.
    Improving/worsening follows the line's polarity."""
    w = W.partitionBy("q", "section_id", "label").orderBy(F.col("week").desc())
    last = (long.where(F.col("value").isNotNull()).withColumn("rn", F.row_number().over(w))
            .where(F.col("rn") <= 3))
    g = last.groupBy("q", "section_id", "label").agg(
        F.max(F.when(F.col("rn") == 1, F.col("value"))).alias("v_last"),
        F.max_by("value", "rn").alias("v_first"), F.max("rn").alias("n_weeks"))
    spec = F.broadcast(spark_spec.select("section_id", "label", "invert_gap"))
    g = g.join(spec, ["section_id", "label"])
    delta = F.col("v_last") - F.col("v_first")
    signed = F.when(F.col("invert_gap"), -delta).otherwise(delta)
    flat = F.abs(delta) <= F.abs(F.col("v_first")) * tol
    trend = (F.when(F.col("n_weeks") < 2, F.lit(None).cast("string")).when(flat, F.lit("stable"))
             .when(signed > 0, F.lit("improving")).otherwise(F.lit("worsening")))
    return g.select("q", "section_id", "label", "n_weeks", "v_first", "v_last", trend.alias("trend"))


def kpi_pull(rows: DataFrame) -> DataFrame:
    """How hard each KPI pulls its section: |gap| / |target QTD|, ranked
    within the section (window over the few lines of one section)."""
    g = rows.where(F.col("gap").isNotNull())
    pull = safe_div(F.abs(F.col("gap")), F.abs(F.col("qtd")))
    w = W.partitionBy("q", "section_id").orderBy(F.col("pull").desc_nulls_last(), "label")
    return (g.select("q", "section_id", "label", "gap", round_half_away(pull, 6).alias("pull"))
            .withColumn("pull_rank", F.row_number().over(w)))


def _plain(value: str):
    """A number as JSON shall show it: six decimals, never an exponent."""
    return round_half_away(value, 6).cast("decimal(38,6)")


def report_json(on_axis: DataFrame, rows: DataFrame) -> DataFrame:
    """One JSON object per report line: section, label, format, its state
    where it has no source, else its weeks in order (future weeks included,
    as null), QTD and GAP; numbers with six decimals, fields without
    a value written as null. The list holds the weeks of one quarter (bounded)."""
    vals = on_axis.groupBy("q", "section_id", "label").agg(
        F.array_sort(F.collect_list(F.struct(F.date_format("week", "yyyy-MM-dd").alias("week"),
                                             _plain("value").alias("value")))).alias("weeks"))
    j = rows.join(vals, ["q", "section_id", "label"])
    payload = F.struct(F.col("section_id").alias("section"), "label", "format",
                       F.when(F.col("state") != "value", F.col("state")).alias("state"),
                       F.when(F.col("state") == "value", F.col("weeks")).alias("weeks"),
                       _plain("qtd").alias("qtd"), _plain("gap").alias("gap"))
    return j.select("q", "section_id", "seq", "label", F.to_json(payload, {"ignoreNullFields": "false"}).alias("json"))
