import datetime as dt

from tallyspark.operators import report as R

D = dt.date
W = [D(2026, 4, 6), D(2026, 4, 13), D(2026, 4, 20), D(2026, 4, 27)]


def _spec():
    return [R.Line("s", 1, "Stock", "stock", "integer", "last_value"),
            R.Line("s", 2, "Flow", "flow", "integer", "additive"),
            R.Line("s", 3, "Target Flow", "flow_tg", "integer", "additive", gap_against="Flow"),
            R.Line("s", 4, "Rate", "rate", "percent", "weighted_ratio", "num", "den"),
            R.Line("s", 5, "HC", "hc", "number", "avg"),
            R.Line("s", 6, "Pending", render_as="pending_definition")]


def _frame(spark):
    # two weeks of actuals; the last two weeks are future (target only)
    rows = [("Q2", W[0], 150000.0, 10.0, 12.0, 0.5, 1.0, 2.0, 4.0),
            ("Q2", W[1], 154424.0, 20.0, 12.0, 0.25, 1.0, 4.0, 6.0),
            ("Q2", W[2], None, None, 12.0, None, None, None, None),
            ("Q2", W[3], None, None, 12.0, None, None, None, None)]
    return spark.createDataFrame(rows, "q string, week date, stock double, flow double, flow_tg double, "
                                       "rate double, num double, den double, hc double")


def test_qtd_rules_and_gap(spark):
    spec = _spec()
    long = R.values_long({"s": _frame(spark)}, spec)
    sf = R.spec_frame(spark, spec)
    q = {r["label"]: r["qtd"] for r in R.qtd(long, sf).collect()}
    assert q["Stock"] == 154424.0          # stock QTD = last week with an actual
    assert q["Flow"] == 30.0               # additive over weeks with values
    assert q["Target Flow"] == 24.0        # target only over weeks with actual (not 48)
    assert q["Rate"] == 2.0 / 6.0          # ratio of sums, not mean of ratios (0.375)
    assert q["HC"] == 5.0
    g = {r["label"]: r["gap"] for r in R.gap(long, sf).collect()}
    assert g == {"Target Flow": 6.0}


def test_axis_keeps_future_weeks_null_and_text_states(spark):
    spec = _spec()
    long = R.values_long({"s": _frame(spark)}, spec)
    axis = spark.createDataFrame([("Q2", w) for w in W], "q string, week date")
    on = R.section_on_axis(long, axis, spec)
    assert on.count() == len(W) * len(spec)
    flow = {r["week"]: r["value"] for r in on.where("label = 'Flow'").collect()}
    assert flow[W[3]] is None and flow[W[0]] == 10.0   # NULL, never 0
    states = {r["state"] for r in on.where("label = 'Pending'").collect()}
    assert states == {"Pending definition"}
    cells = {(r["label"], r["cell"]): r["display"] for r in R.display_cells(on, R.spec_frame(spark, spec)).collect()}
    assert cells[("Stock", W[1].isoformat())] == "154,424" and cells[("Rate", W[0].isoformat())] == "50.00%"
    assert cells[("Flow", W[3].isoformat())] == "—"
    rows = R.report_rows(long, axis, R.spec_frame(spark, spec), spec)
    cells = {(r["label"], r["cell"]): r["display"] for r in R.display_cells(on, R.spec_frame(spark, spec), rows).collect()}
    assert ("Stock", "QTD") in cells and cells[("Pending", "GAP")] == "Pending definition"


def test_report_rows_class_and_trend(spark):
    spec = _spec()
    long = R.values_long({"s": _frame(spark)}, spec)
    axis = spark.createDataFrame([("Q2", w) for w in W], "q string, week date")
    sf = R.spec_frame(spark, spec)
    rows = R.report_rows(long, axis, sf, spec)
    assert rows.count() == len(spec)
    cls = {r["label"]: r for r in R.row_class(rows).collect()}
    assert cls["Target Flow"]["is_target"] and not cls["Flow"]["is_target"]
    assert cls["Target Flow"]["gap_is_good"] is True
    tr = {r["label"]: r["trend"] for r in R.kpi_trend(long, sf).collect()}
    assert tr["Flow"] == "improving" and tr["Rate"] == "worsening" and tr["HC"] == "improving"
    assert tr["Target Flow"] == "stable"


def test_full_spec_shape():
    spec = R.report_spec()
    by = {}
    for ln in spec:
        by.setdefault(ln.section_id, []).append(ln)
    assert len(by["main_metrics_top"]) == 6 and len(by["main_metrics_bottom"]) == 3
    assert len(by["inside_sales_outbound"]) == 20 and len(by["inside_sales_inbound"]) == 21 and len(spec) == 113
    assert by["inside_sales_inbound"][2].label == "Target Inbound Verified Leads" and by["inside_sales_inbound"][2].render_as == "missing_source"
    assert all([ln.seq for ln in lines] == list(range(1, len(lines) + 1)) for lines in by.values())
    assert len(by["hunting"]) == 20 and len(by["self_onboarding"]) == 7 and len(by["brand_expansion"]) == 6
    assert all(len(by[f"early_churn_m{i}"]) == 10 for i in (1, 2, 3))
    labels = {(ln.section_id, ln.label) for ln in spec}
    assert all((ln.section_id, ln.gap_against) in labels for ln in spec if ln.gap_against)
