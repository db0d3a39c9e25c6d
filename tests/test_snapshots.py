import datetime as dt

from tallyspark.operators import kpi as K
from tallyspark.operators import quality as X
from tallyspark.operators import stores as P

D = dt.date
KIND = "store_id long, day date, loaded_at timestamp, load_id long, stock double"


def at(day, hour, minute=0):
    return dt.datetime(2026, 4, day, hour, minute)


def shown(spark, rows, refreshes):
    df = P.snapshots_as_of(spark.createDataFrame(rows, KIND), refreshes, "store_id", "day", "loaded_at", "load_id")
    return {(r.refresh_day.day, r.store_id): (r.load_id, r.age_days) for r in df.collect()}


def test_a_refresh_shows_what_was_loaded_before_its_cutoff(spark):
    # 13:15 UTC is 08:15 in Bogota: loaded a minute before is shown that day, at the cutoff itself on the next.
    rows = [(1, D(2026, 4, 1), at(2, 13, 14), 10, 1.0), (1, D(2026, 4, 2), at(3, 13, 15), 11, 2.0)]
    assert shown(spark, rows, ["2026-04-01", "2026-04-02", "2026-04-03", "2026-04-04"]) == {(2, 1): (10, 1), (3, 1): (10, 2), (4, 1): (11, 2)}


def test_late_days_never_win_and_repeated_loads_correct_the_day(spark):
    rows = [(1, D(2026, 4, 5), at(5, 20), 1, 1.0), (1, D(2026, 4, 3), at(8, 20), 2, 9.0),   # an older day, loaded late
            (1, D(2026, 4, 5), at(10, 20), 3, 5.0), (1, D(2026, 4, 5), at(10, 20), 4, 6.0),  # the day again, twice at once
            (2, D(2026, 4, 9), at(9, 1), 5, 1.0), (None, D(2026, 4, 9), at(9, 1), 6, 1.0), (3, None, at(1, 1), 7, 1.0), (4, D(2026, 4, 9), None, 8, 1.0),
            (5, D(2026, 4, 30), at(30, 20), 9, 1.0)]
    got = shown(spark, rows, ["2026-04-07", "2026-04-10", "2026-04-12", "2026-04-12"])
    assert got == {(7, 1): (1, 2), (10, 1): (1, 5), (12, 1): (4, 7), (10, 2): (5, 1), (12, 2): (5, 3), (10, None): (6, 1), (12, None): (6, 3)}


def test_latest_state_is_hashed_not_sorted(spark):
    rows = [(1, D(2026, 4, 1), 5, "a"), (1, D(2026, 4, 2), -3, "b"), (1, D(2026, 4, 2), 7, None), (2, None, 1, "c"), (2, D(1900, 1, 1), None, "d"),
            (None, D(2026, 4, 1), 1, "e"), (3, D(2026, 4, 1), 2**62, "f"), (3, D(2026, 4, 1), 2**62 - 1, "g"), (4, D(9999, 12, 31), 9, "h"), (5, None, None, "i")]
    h = spark.createDataFrame(rows, "external_store_id long, day_date date, order_id long, status string")
    got = P.store_latest(h)
    assert {(r.external_store_id, r.status) for r in got.collect()} == {(1, None), (2, "d"), (None, "e"), (3, "f"), (4, "h"), (5, "i")}
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


SILVER = "hunter_ string, store_id long, razon_social string, brand_name string, adress string, first_login date, orders_0_28 long, handoff string"


def test_gold_check_reports_what_disagrees(spark):
    rows = [("h", 1, "L1", "B", "A1", None, 0, "COMPLETED"), ("h", 2, "L1", "B", "A2", D(2026, 3, 5), 0, "PENDING"), ("h", 3, "L2", "B", "A2", D(2026, 3, 9), 4, "COMPLETED"),
            ("h", 4, "L2", None, "A2", D(2026, 4, 9), 4, "COMPLETED"), (None, 5, "L3", "C", "A3", None, 1, "COMPLETED")]
    silver = spark.createDataFrame(rows, SILVER)
    gold = X.gold_table(silver, "2026-04-20")
    h = gold.where("hunter_ = 'h'").first()
    assert (h.razon_social_wo, h.total_store_razon_social_wo, h.store_sin_login_razon_social_wo) == ("L1", 2, 1)
    assert (h.churnm1, h.store_sin_login_rate, h.brand_name_wo) == (0.5, 0.25, "B")  # of two logins in March one has no order
    assert all(r.ok for r in X.gold_check(gold, gold).collect())
    stale = X.gold_table(silver.where("store_id <> 1 AND hunter_ IS NOT NULL"), "2026-04-20")
    bad = {(r.hunter_, r.field): (r.stored, r.derived) for r in X.gold_check(stale, gold).where("NOT ok").collect()}
    assert bad[("h", "total_store")] == ("3", "4") and bad[("h", "razon_social_wo")] == ("L2", "L1") and bad[(None, "hunter_")] == (None, "yes")
    assert ("h", "churnm1") not in bad and ("h", "brand_name_wo") not in bad


def test_every_grouping_of_the_cube_adds_up(spark):
    rows = [("2026-Q2", "HUNTING", "MX", "J", 4, 6.0), ("2026-Q2", "HUNTING", "MX", None, 2, None), ("2026-Q2", "INSIDE", "CO", "J", 1, 0.5), ("2026-Q3", "HUNTING", "CO", "S", 1, 1.0)]
    got = K.gap_cube(spark.createDataFrame(rows, "q string, channel string, country string, aging string, actual long, target double")).collect()
    for q, gap in (("2026-Q2", 0.5), ("2026-Q3", 0.0)):
        grains = {r.grain for r in got if r.q == q}
        assert len(grains) == 8
        for g in grains:
            part = [r for r in got if r.q == q and r.grain == g]
            assert sum(r.gap for r in part) == gap and sorted(r.rank for r in part) == list(range(1, len(part) + 1))
            assert gap == 0 and all(r.share is None for r in part) or abs(sum(r.share for r in part) - 1) < 1e-9
    aging = {(r.aging, r.gap) for r in got if r.q == "2026-Q2" and r.grain == "aging"}
    assert aging == {("J", -1.5), (None, 2.0)}
