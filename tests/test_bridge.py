import datetime as dt
import random

from pyspark.sql import functions as F

from tallyspark.operators import bridge as B
from tallyspark.operators import shapley as S
from tallyspark.operators import waterfall as WF

D = dt.date
FUNNEL = ("q string, week_date date, country string, proyecto_agrupado string, aging_category_final string, "
          "hunter_email string, hc int, dias_trabajados long, stores_totales long")
TARGET = "q string, week date, country string, proyecto string, aging string, tipo_target string, target double"


def _data(spark, seed=7):
    rnd = random.Random(seed)
    weeks = [D(2026, 4, 6), D(2026, 4, 13)]
    f, t = [], []
    for w in weeks:
        for c in ("CO", "MX"):
            for p in ("OUTBOUND", "INBOUND"):
                for i, a in enumerate(("New Entry", "Junior", "Senior", "Other")):
                    for r in range(3):
                        f.append(("Q2", w, c, p, a, f"{c}{a}{r}", rnd.choice([0, 1, 1]), rnd.randint(0, 5),
                                  rnd.randint(0, 9)))
                    if a != "Other":
                        lab = f"0{i + 1} - {a}"
                        hc, pr = float(rnd.randint(1, 3)), rnd.choice([0.5, 0.75, 1.0])
                        t += [("Q2", w, c, p, lab, "HC", hc), ("Q2", w, c, p, lab.upper(), "PRODUCTIVIDAD", pr),
                              ("Q2", w, c, p, f" {lab} ", "STORES", hc * pr * 4)]
        # a target-only cell in a country without reps
        t += [("Q2", w, "PE", "INBOUND", "02 - junior", k, v) for k, v in (("HC", 2.0), ("PRODUCTIVIDAD", 1.0),
                                                                         ("STORES", 8.0))]
    return spark.createDataFrame(f, FUNNEL), spark.createDataFrame(t, TARGET)


def test_full_outer_join_keeps_every_cell(spark):
    f, t = _data(spark)
    cells = B.bridge_is_cells(f, t)
    real = f.groupBy("q", "week_date", "country", "proyecto_agrupado", "aging_category_final").count().count()
    tg = t.select("q", "week", "country", "proyecto", F.upper(F.trim("aging"))).distinct().count()
    matched = 2 * 2 * 2 * 3   # weeks x countries x projects x mapped agings
    assert cells.count() == real + tg - matched
    tot = cells.agg(F.sum("stores_real").alias("r"), F.sum("stores_tg").alias("t")).first()
    assert tot["r"] == f.agg(F.sum("stores_totales")).first()[0]
    assert tot["t"] == t.where("tipo_target = 'STORES'").agg(F.sum("target")).first()[0]


def test_is_bridge_closes_exactly(spark):
    f, t = _data(spark)
    e = B.bridge_is_effects(f, t)
    assert all(r["cierre_check"] == 0.0 for r in B.bridge_is_totals(e).collect())
    rep = B.bridge_is_report(e).orderBy("seq").collect()
    assert [r["label"] for r in rep][:3] == ["OB – Productividad", "OB – Headcount", "OB – Maturity"]
    total = B.bridge_is_totals(e).first()
    assert abs(sum(r["delta"] for r in rep) - total["desvio_total"]) <= 1


def test_is_bridge_keeps_a_third_project(spark):
    f, t = _data(spark)
    f = f.union(f.where("proyecto_agrupado = 'INBOUND'").withColumn("proyecto_agrupado", F.lit("FIELD")))
    e = B.bridge_is_effects(f, t)
    rep = B.bridge_is_report(e).orderBy("seq").collect()
    assert [r["seq"] for r in rep] == list(range(1, 10)) and rep[6]["label"] == "FIELD – Productividad"
    real = f.groupBy("q").agg(F.sum("stores_totales").cast("double").alias("actual")).select(F.lit("IS").alias("bridge"), "q", "actual")
    assert all(r["ok"] for r in WF.bridge_closure(WF.is_bridge_long(e), actual=real).collect())


def test_null_rep_is_no_rep_but_its_stores_count(spark):
    from tallyspark.operators import deepdive as DD
    from tallyspark.operators import kpi as K
    rows = [("Q2", D(2026, 4, 6), "CO", "INBOUND", "Junior", e, 1, 5, 3) for e in ("a@x", None)]
    f = spark.createDataFrame(rows, FUNNEL)
    t = spark.createDataFrame([("Q2", D(2026, 4, 6), "CO", "INBOUND", "02 - Junior", "HC", 1.0)], TARGET)
    cell = B.bridge_is_cells(f, t).first()
    assert (cell["hc_real"], cell["stores_real"], cell["dias_real"]) == (1, 6, 10)
    cell = B.bridge_ht_real(f.drop("proyecto_agrupado")).first()
    assert (cell["hc_real"], cell["stores_real"]) == (1, 6)
    week = K.headcount_weekly(f.withColumn("proyecto", F.col("proyecto_agrupado"))).first()
    assert (week["headcount"], week["stores_real"], week["dias_real"]) == (1, 6, 10)
    calc = spark.createDataFrame([("Q2", "INBOUND", "CO", "Junior", "b", e, 5, 3, 2.0, 0.5) for e in ("a@x", None)],
                                 "q string, proyecto string, country string, aging string, bucket string, hunter_email string, "
                                 "dias long, stores long, stores_tg_hunter double, prod_target double")
    block = DD.dd_grains(calc, "IS", ("total",)).first()
    assert (block["hunters"], block["stores"]) == (1, 6)


def test_excluded_weeks_leave_both_sides(spark):
    f, t = _data(spark)
    out = spark.createDataFrame([(D(2026, 4, 13),)], "week date")
    one, two = f.where("week_date < '2026-04-13'"), t.where("week < '2026-04-13'")
    assert B.bridge_is(f, t, exclude=out).exceptAll(B.bridge_is(one, two)).count() == 0
    h, g = f.drop("proyecto_agrupado"), t.where("proyecto = 'INBOUND'").drop("proyecto")
    for mode in ("QTD", "LW"):
        a, b = B.bridge_ht(h, g, mode, exclude=out), B.bridge_ht(one.drop("proyecto_agrupado"), two.where("proyecto = 'INBOUND'").drop("proyecto"), mode)
        assert a.collect() == b.collect()


def test_ht_worlds_and_official_target(spark):
    f, t = _data(spark)
    ht_f = f.drop("proyecto_agrupado")
    ht_t = t.where("proyecto = 'INBOUND'").drop("proyecto")
    cells = B.bridge_ht_cells(ht_f, ht_t)
    w = B.bridge_ht_worlds(cells).first()
    # S3 counts only cells that have a target (the leak is reported by unmatched_real)
    s3 = cells.agg(F.sum("stores_real")).first()[0]
    assert w["s3"] == float(s3)
    um = B.unmatched_real(ht_f, ht_t).first()
    assert um["total_real_stores"] - um["unmatched_stores"] == s3
    br = B.bridge_ht(ht_f, ht_t).first()
    assert br["actual"] == w["s3"] and br["target_reconstruido"] == w["s0"]
    # with the stores of cells without a target the bridge reaches every real store
    assert br["actual_total"] == float(um["total_real_stores"]) and br["ef_sin_target"] == float(um["unmatched_stores"])
    assert all(r["ok"] for r in WF.bridge_closure(WF.ht_bridge_long(B.bridge_ht(ht_f, ht_t))).collect())


def test_waterfall_golden_and_closure(spark):
    # IS effect table: -276 -264 +321 +35 +286 +0 = +102
    rows = [("IS", "Q2", 0, "Target", "base", 1000.0)]
    rows += [("IS", "Q2", i + 1, f"e{i}", "effect", float(d)) for i, d in enumerate([-276, -264, 321, 35, 286, 0])]
    rows += [("IS", "Q2", 7, "Real", "total", 1102.0)]
    # off by one from rounding (6617 -> 6314, effects -302): inside tolerance 1
    rows += [("OB1", "Q2", 0, "Target", "base", 6617.0), ("OB1", "Q2", 1, "e", "effect", -302.0),
             ("OB1", "Q2", 2, "Real", "total", 6314.0)]
    # must fail: 3930 -> 3561 with effects -476
    rows += [("BAD", "Q2", 0, "Target", "base", 3930.0), ("BAD", "Q2", 1, "e", "effect", -476.0),
             ("BAD", "Q2", 2, "Real", "total", 3561.0)]
    long = spark.createDataFrame(rows, "bridge string, q string, seq int, label string, kind string, delta double")
    bars = {(r["bridge"], r["seq"]): r for r in WF.waterfall_bars(long).collect()}
    assert (bars[("IS", 1)]["start"], bars[("IS", 1)]["end"]) == (1000.0, 724.0)
    assert bars[("IS", 6)]["end"] == 1102.0 and bars[("IS", 7)]["start"] == 0.0
    assert bars[("IS", 7)]["end"] == 1102.0 and bars[("IS", 1)]["pct_of_base"] == -27.6
    ok = {r["bridge"]: r["ok"] for r in WF.bridge_closure(long).collect()}
    assert ok == {"IS": True, "OB1": True, "BAD": False}


def test_shapley_efficiency_and_symmetry(spark):
    f, t = _data(spark, seed=11)
    cells = B.bridge_is_cells(f, t)
    for r in S.shapley_bridge(cells).collect():
        assert abs(r["closure"]) < 1e-6
        # each output is rounded to 6 decimals, so sums of five of them agree to ~1e-5
        assert abs(r["target_total"] + r["ef_productivity"] + r["ef_capacity"] + r["ef_maturity"] - r["real_total"]) < 1e-5
    real = cells.groupBy("q").agg(F.sum("stores_real")).first()[1]
    assert abs(sum(r["real_total"] for r in S.shapley_bridge(cells).collect()) - real) < 1e-6
    ht_f, ht_t = f.drop("proyecto_agrupado"), t.where("proyecto = 'INBOUND'").drop("proyecto")
    ht = S.shapley_bridge(B.shapley_ht_cells(ht_f, ht_t), ("q", "country", "week"), ("q",)).first()
    assert ht["real_total"] == float(ht_f.agg(F.sum("stores_totales")).first()[0]) and ht["closure"] == 0.0
    # only productivity differs: the whole gap is productivity
    rows = [("Q2", "P", "CO", D(2026, 4, 6), 10, 30, 10.0, 1.0),
            ("Q2", "P", "CO", D(2026, 4, 6), 20, 60, 40.0, 2.0)]
    c = spark.createDataFrame(rows, "q string, proyecto string, country string, week date, dias_real long, "
                                    "stores_real long, stores_tg double, prod_tg double")
    r = S.shapley_bridge(c).first()
    # same days and mix on both sides: target 50, real 90, all of it productivity
    assert r["target_total"] == 50.0 and r["real_total"] == 90.0
    assert abs(r["ef_productivity"] - 40.0) < 1e-9
    assert abs(r["ef_capacity"]) < 1e-9 and abs(r["ef_maturity"]) < 1e-9


def test_ht_zero_headcount_option_only_moves_the_loss(spark):
    f, t = _data(spark, seed=3)
    ht_f = f.drop("proyecto_agrupado").withColumn("hc", F.when(F.col("country") == "MX", 0).otherwise(F.col("hc")))
    ht_t = t.where("proyecto = 'INBOUND'").drop("proyecto")
    a = B.bridge_ht(ht_f, ht_t, zero_hc="maturity").first()
    b = B.bridge_ht(ht_f, ht_t, zero_hc="headcount").first()
    assert a["ef_prod"] == b["ef_prod"] and a["ef_ausencias"] == b["ef_ausencias"]
    # MX has no active rep: the SQL rule books its loss as maturity, the option as headcount
    assert abs((a["ef_madurez"] + a["ef_hc"]) - (b["ef_madurez"] + b["ef_hc"])) < 0.11
    assert b["ef_hc"] < a["ef_hc"]
