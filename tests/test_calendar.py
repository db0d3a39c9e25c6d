import datetime as dt

from tallyspark.operators import calendar as C

D = dt.date


def _funnel(spark, last):
    weeks = [D(2026, 3, 30), D(2026, 4, 6), D(2026, 4, 13), D(2026, 4, 20), D(2026, 4, 27)]
    rows = [("Q2", w) for w in weeks if w <= last]
    return spark.createDataFrame(rows, "q string, week_date date")


def test_weeks_with_actuals_qtd_and_lw(spark):
    # weeks through 27-Apr loaded -> QTD 5 weeks, LW 27-Apr
    f = _funnel(spark, D(2026, 4, 27))
    assert C.weeks_available(f).count() == 5
    assert C.last_week(f).first()["last_week"] == D(2026, 4, 27)
    # through 20-Apr -> 4 weeks, LW 20-Apr
    f = _funnel(spark, D(2026, 4, 20))
    assert C.weeks_available(f).count() == 4
    assert C.last_week(f).first()["last_week"] == D(2026, 4, 20)


def test_closed_weeks_cut_in_bogota(spark):
    weeks = spark.createDataFrame([(D(2026, 4, d),) for d in (6, 13, 20, 27)] + [(D(2026, 5, 4),)], "week date")
    # Monday 4-May 08:00 in Bogota: the week of 4-May is still open
    got = sorted(r["week"] for r in C.closed_weeks(weeks, "2026-05-04 13:00:00").collect())
    assert got[-1] == D(2026, 4, 27)
    # Tuesday 28-Apr: closed through 20-Apr
    got = sorted(r["week"] for r in C.closed_weeks(weeks, "2026-04-28 15:00:00").collect())
    assert got[-1] == D(2026, 4, 20)
    # 02:00 UTC Monday is still Sunday in Bogota
    got = sorted(r["week"] for r in C.closed_weeks(weeks, "2026-05-04 02:00:00").collect())
    assert got[-1] == D(2026, 4, 20)


def test_align_weeks_drops_target_weeks_without_actuals_and_exclusions(spark):
    f = _funnel(spark, D(2026, 4, 20))
    t = spark.createDataFrame([("Q2", D(2026, 4, 6), 1.0), ("Q2", D(2026, 4, 27), 1.0),
                               ("Q2", D(2026, 4, 13), 1.0)], "q string, week date, target double")
    ex = spark.createDataFrame([(D(2026, 4, 13),)], "week date")
    got = sorted(r["week"] for r in C.align_weeks(t, f, exclude=ex).collect())
    assert got == [D(2026, 4, 6)]
    rep = C.alignment_report(f, C.align_weeks(t, f)).first()
    assert rep["n_weeks_real"] == 4 and rep["n_weeks_target_used"] == 2 and rep["ok"]


def test_snapshot_day_respects_refresh_cutoff(spark):
    ev = spark.createDataFrame([(dt.datetime(2026, 5, 4, 13, 0),), (dt.datetime(2026, 5, 4, 13, 30),)], "ts timestamp")
    got = [r["snapshot_day"] for r in C.snapshot_day(ev, "ts").orderBy("ts").collect()]
    # 08:00 Bogota is before the 08:15 refresh -> still the previous day's data
    assert got == [D(2026, 5, 3), D(2026, 5, 4)]
