import datetime as dt

from tallyspark.operators import churn as CH

D = dt.date
DETAIL = "week date, country string, age string, channel_am string, churn long, total_store long"
TARGET = ("week string, country string, channel_am string, `TARGET_%CHURN_M1` double, "
          "`TARGET_%CHURN_M2` double, `TARGET_%CHURN_M3` double")


def _run(spark, detail, target, as_of="2026-05-04 13:00:00"):
    axis = spark.createDataFrame([("Q2", D(2026, 4, 20)), ("Q2", D(2026, 4, 27))], "q string, week date")
    return CH.early_churn(spark.createDataFrame(detail, DETAIL), spark.createDataFrame(target, TARGET), axis, as_of)


def test_anomaly_golden_row(spark):
    # BE M1 week of 20-Apr: 53.3 % churn vs 6.8 % target -> +46.5 pp, anomaly
    detail = [(D(2026, 4, 20), "CO", "M1", "Brand Expansion", 533, 1000)]
    target = [("2026-04-20", "TOTAL", "BE", 0.068, 0.05, 0.05),
              ("2026-04-20", "CO", "BE", 0.9, 0.9, 0.9)]        # only TOTAL targets apply
    rows = {r["canal"]: r for r in _run(spark, detail, target).collect()}
    be = rows["BE"]
    assert abs(be["churn_pct"] - 0.533) < 1e-12 and be["target_pct"] == 0.068  # 53.3 / 100 in binary
    assert be["delta_pp"] == 46.5 and be["is_anomaly"] is True
    assert rows["TOTAL"]["churn_stores"] == 533          # TOTAL row from the same aggregation


def test_missing_target_keeps_nulls(spark):
    detail = [(D(2026, 4, 20), "CO", "M2", "HUNTING", 1, 10)]
    r = _run(spark, detail, [("2026-04-20", "TOTAL", "IS", 0.1, 0.1, 0.1)]).where("canal = 'HUNTING'").first()
    assert r["target_pct"] is None and r["delta_pp"] is None and r["is_anomaly"] is None


def test_exclusions_and_total_semantics(spark):
    detail = [(D(2026, 4, 20), "BR", "M1", "Hunting", 9, 10),      # Brazil excluded
              (D(2026, 4, 20), None, "M1", "Hunting", 9, 10),      # NULL country drops too (!= 'BR')
              (D(2026, 4, 20), "CO", "M1", "Partners", 1, 10),     # unmapped channel: only in TOTAL
              (D(2026, 4, 20), "CO", "M1", "inside sales", 2, 10),
              (D(2026, 5, 4), "CO", "M1", "Hunting", 5, 5)]        # open week cut off
    out = _run(spark, detail, [])
    got = {(r["canal"], r["week"]): (r["churn_stores"], r["total_stores"]) for r in out.collect()}
    assert got == {("IS", D(2026, 4, 20)): (2, 10), ("TOTAL", D(2026, 4, 20)): (3, 20)}
    mapped = CH.early_churn(spark.createDataFrame(detail, DETAIL), spark.createDataFrame([], TARGET),
                            spark.createDataFrame([("Q2", D(2026, 4, 20))], "q string, week date"),
                            "2026-05-04 13:00:00", mapped_only=True)
    assert {r["canal"]: r["churn_stores"] for r in mapped.collect()}["TOTAL"] == 2


def test_qtd_weights_target_by_stores_with_target_only(spark):
    detail = [(D(2026, 4, 20), "CO", "M1", "Hunting", 10, 100), (D(2026, 4, 27), "CO", "M1", "Hunting", 30, 100)]
    target = [("2026-04-20", "TOTAL", "HUNTING", 0.25, 0.0, 0.0)]
    q = {r["canal"]: r for r in CH.churn_qtd(_run(spark, detail, target)).collect()}["HUNTING"]
    assert q["churn_qtd"] == 0.2 and q["target_qtd"] == 0.25 and abs(q["gap_qtd"] + 0.05) < 1e-12
    assert q["weeks"] == 2 and q["weeks_with_target"] == 1


def test_completeness_lists_missing_cells(spark):
    detail = [(D(2026, 4, 20), "CO", "M1", "Hunting", 1, 10)]
    miss = CH.churn_completeness(_run(spark, detail, []))
    # 1 week x 3 ages x 5 channels = 15 expected; HUNTING and TOTAL exist for M1
    assert miss.count() == 13
