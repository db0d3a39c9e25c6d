"""The weekly facts of suppliers: their values, and one pass over lineitem whose tasks stay small."""
import datetime as dt

from tallyspark.sources import model, testdata



def _tables(spark, tmp_path):
    day = lambda s: dt.datetime.fromisoformat(s)
    rows = [(1, day("2026-04-06"), 0.05, "N", "O"), (1, day("2026-04-06"), 0.01, "R", "O"), (1, day("2026-04-06"), 0.05, "N", "F"), (1, day("2026-04-12"), 0.10, "N", "F"),
            (1, day("2026-04-08"), None, None, None), (1, None, 0.0, "N", "O"), (1, None, 0.0, "N", "O"), (2, day("2026-04-07"), 0.02, "R", "O"),
            (None, day("2026-04-07"), 0.02, "N", "O"), (9, day("2026-04-07"), 0.02, "N", "O")]
    spark.createDataFrame(rows, "l_suppkey bigint, l_shipdate timestamp, l_discount double, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "S1", 0), (2, "S2", 0), (2, "S2", 0)], "s_suppkey bigint, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(0, "CO", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    return str(tmp_path)


def test_a_day_of_a_supplier_counts_once_per_project_and_once_for_all(spark, tmp_path):
    d = _tables(spark, tmp_path)
    for t in (testdata.is_funnel(spark, d), model.materialized(spark, d, "is_funnel")):
        got = sorted((r.q or "", r.hunter_email, r.proyecto, r.dias_trabajados, r.stores_totales) for r in t.collect())
        assert got == [("", "S1", "OUTBOUND", 1, 2), ("2026-Q2", "S1", "INBOUND", 1, 2), ("2026-Q2", "S1", "OUTBOUND", 1, 1),
                       ("2026-Q2", "S2", "OUTBOUND", 1, 0), ("2026-Q2", "S2", "OUTBOUND", 1, 0)]
    for t in (testdata.ht_funnel(spark, d), model.materialized(spark, d, "ht_funnel")):
        got = sorted((r.q or "", r.hunter_email, r.dias_trabajados, r.stores_totales) for r in t.collect())
        assert got == [("", "S1", 1, 2), ("2026-Q2", "S1", 1, 3), ("2026-Q2", "S2", 1, 0), ("2026-Q2", "S2", 1, 0)]


def test_the_scan_keeps_no_hash_table_of_suppliers_and_both_funnels_share_one_pass(spark, tmp_path):
    d = _tables(spark, tmp_path)
    plan = testdata.supplier_week(spark, d)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("HashAggregate") < plan.index("Exchange") and "HashAggregate" not in plan[plan.index("Exchange"):]
    for name in ("is_funnel", "ht_funnel"):
        model.materialized(spark, d, name)
    assert (spark.sparkContext.applicationId, d, "supplier_week") in model._STORED
