"""Distinct reps per week: their values, and a plan without a hash table of all reps."""
import datetime as dt
import re

from pyspark.sql import functions as F

from tallyspark.functions.counting import distinct_counts
from tallyspark.operators import bridge as B
from tallyspark.operators import kpi as K

FUNNEL = "q string, week_date date, country string, proyecto string, proyecto_agrupado string, aging_category_final string, hunter_email string, hc int, dias_trabajados bigint, stores_totales bigint"
TARGET = "q string, week date, country string, proyecto string, aging string, tipo_target string, target double"
W = dt.date(2026, 4, 6)


def _funnel(spark):
    row = lambda aging, who, hc, days, made, country="CO": ("Q", W, country, "OUTBOUND", "OUTBOUND", aging, who, hc, days, made)
    return spark.createDataFrame([row("Junior", "a", 1, 3, 2), row("Senior", "a", 1, 2, 1), row("Senior", "a", 1, 2, 1), row("Senior", "b", 0, 4, 5),
                                  row("Junior", "b", 1, 1, None, "MX"), row("Senior", None, 1, 6, 7), row(None, "c", None, 1, 1)], FUNNEL)


def _rep_tables(df):
    """Hash tables keyed by rep in the plan."""
    return re.findall(r"HashAggregate\(keys=\[[^\]]*hunter_email", df._jdf.queryExecution().executedPlan().toString())


def test_distinct_counts_leave_nulls_out_and_count_marked_values_once(spark):
    rows = spark.createDataFrame([("g", "a", False), ("g", "a", True), ("g", "a", True), ("g", "b", False), ("g", None, True), (None, "a", True)], "k string, v string, m boolean")
    got = {r.k: (r.n, r.marked) for r in distinct_counts(rows, ["k"], "v", "n", F.col("m")).collect()}
    assert got == {"g": (2, 1), None: (1, 1)}


def test_reps_of_a_week_are_counted_without_a_hash_table_of_reps(spark):
    target = spark.createDataFrame([("Q", W, "CO", "OUTBOUND", "03 - Senior", "HC", 2.0), ("Q", dt.date(2026, 4, 13), "CO", "OUTBOUND", "03 - Senior", "HC", 2.0)], TARGET)
    reps = K.rep_weekly(_funnel(spark), target)
    assert not _rep_tables(reps)
    got = {r.week.day: (r.headcount, r.senior_headcount, r.stores_real, r.dias_real, r.target_headcount) for r in reps.collect()}
    assert got == {6: (2, 1, 17, 19, 2.0), 13: (None, None, None, None, 2.0)}
    heads = K.headcount_weekly(_funnel(spark))
    assert not _rep_tables(heads)
    assert [(r.headcount, r.senior_headcount, r.stores_real, r.dias_real) for r in heads.collect()] == [(2, 1, 17, 19)]
    idle = K.headcount_weekly(_funnel(spark).where("hc = 0"))
    assert [(r.headcount, r.senior_headcount) for r in idle.collect()] == [(0, 0)]


def test_bridge_cells_count_reps_without_a_hash_table_of_reps(spark):
    cells = B.is_real_cells(_funnel(spark))
    assert not _rep_tables(cells) and not _rep_tables(B.ht_real_cells(_funnel(spark)))
    got = {(r.aging_norm, r.country): (r.hc_real, r.dias_real, r.dias_active, r.stores_real) for r in cells.collect()}
    assert got == {("02 - JUNIOR", "CO"): (1, 3, 3, 2), ("03 - SENIOR", "CO"): (1, 14, 10, 14), ("02 - JUNIOR", "MX"): (1, 1, 1, None), (None, "CO"): (0, 1, 0, 1)}
