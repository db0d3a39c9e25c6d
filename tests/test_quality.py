import datetime as dt

from tallyspark.operators import quality as X
from tallyspark.operators import stores as P

D = dt.date
SILVER = ("store_id long, hunter_ string, coordinador string, channel string, razon_social string, "
          "brand_name string, adress string, orders_0_28 long, handoff string, "
          "fecha_envio_de_credenciales date, first_login date, orders_cancel_partner_0_28 long")


def _silver(spark):
    s, d = D(2026, 1, 1), D(2026, 1, 2)
    rows = [(1, "ana", "c1", "HUNTING", "L1", "B1", "A1", 0, "PENDING", s, None, 4),
            (2, "ana", "c1", "HUNTING", "L1", "B2", "A1", 3, "COMPLETED", s, d, 0),
            (3, "ana", "c1", "HUNTING", "L2", "B2", "A2", 0, "COMPLETED", s, None, 5),
            (4, "ana", "c2", "IS", "L2", "B3", "A3", 1, "COMPLETED", s, d, 0),
            (5, "bob", "c2", "IS", "L9", "B9", "A9", 0, "PENDING", s, d, 1)]
    return spark.createDataFrame(rows, SILVER)


def test_gold_counts_and_rates(spark):
    g = {(r["hunter_"], r["coordinador"]): r for r in X.quality_gold(_silver(spark)).collect()}
    a = g[("ana", "c1")]
    assert (a["total_store"], a["store_sin_fl"], a["store_sin_orders"], a["store_sin_handoff"]) == (3, 2, 2, 1)
    assert a["churn"] == 0 and a["total_store_churn"] == 1 and a["churn_rate"] == 0.0
    assert abs(a["store_sin_login_rate"] - 2 / 3) < 1e-12
    b = g[("bob", "c2")]
    assert b["churn"] == 1 and b["churn_rate"] == 1.0   # churn over TOTAL_STORE_CHURN, not TOTAL_STORE


def test_ranking_and_dims(spark):
    r = X.hunter_ranking(X.quality_gold(_silver(spark))).collect()
    assert [x["hunter_"] for x in r] == ["ana", "bob"] and r[0]["total_store"] == 4
    dims = {(x["dim"], x["value"]): x["total_store"] for x in X.quality_by_dim(_silver(spark)).collect()}
    assert dims[("coordinador", "c2")] == 2 and dims[("channel", "HUNTING")] == 3 and dims[("hunter_", "bob")] == 1


def test_worst_offender_tie_breaks(spark):
    wo = {(r["hunter_"], r["entity_type"]): r for r in X.worst_offender(_silver(spark)).collect()}
    # L1 and L2 each have one no-login store and two stores: tie -> name ascending
    assert wo[("ana", "razon_social")]["entity"] == "L1"
    assert (wo[("ana", "razon_social")]["total_store_wo"], wo[("ana", "razon_social")]["store_sin_login_wo"]) == (2, 1)
    # A1 (2 stores, 1 no login) beats A2 (1 store, 1 no login): more stores wins the tie
    assert wo[("ana", "adress")]["entity"] == "A1"
    st = X.offender_stores(_silver(spark), X.worst_offender(_silver(spark)))
    assert sorted(r["store_id"] for r in st.where("entity = 'A1'").collect()) == [1, 2]


def test_store_lists_and_latest(spark):
    s = _silver(spark)
    assert sorted(r["store_id"] for r in X.no_login_stores(s).collect()) == [1, 3]
    pc = {r["hunter_"]: r for r in X.partner_cancellations(s, 3).collect()}
    assert pc["ana"]["stores_high_cancel"] == 2 and pc["ana"]["cancels_high"] == 9
    h = spark.createDataFrame([(1, D(2026, 1, 1), 10, "F"), (1, D(2026, 1, 3), 11, "O"), (1, D(2026, 1, 3), 12, "P"),
                               (2, D(2026, 1, 2), 13, "F")],
                              "external_store_id long, day_date date, order_id long, status string")
    latest = {r["external_store_id"]: r for r in P.store_latest(h).collect()}
    assert latest[1]["order_id"] == 12 and latest[1]["status"] == "P" and latest[2]["order_id"] == 13
    assert P.store_history(h, s.where("store_id = 2")).count() == 1
    cols = P.describe_columns(h).collect()
    assert [c["column_name"] for c in cols] == ["external_store_id", "day_date", "order_id", "status"]
