from pyspark.sql import functions as F

from tallyspark.operators import bridge as B
from tallyspark.operators import deepdive as D
from tallyspark.sources import model

SMOKE = "/root/testdata/sf0.001"


def test_single_quarter_equals_all_quarters_restricted(spark):
    f, t = model.is_funnel(spark, SMOKE), model.is_target(spark, SMOKE)
    quarters = [r["q"] for r in f.select("q").distinct().orderBy("q").limit(3).collect()]
    for q in quarters:
        one = B.bridge_is(f, t, mode="QTD", quarter=q)
        allq = B.bridge_is(f, t, mode="QTD").where(F.col("q") == q)
        assert one.count() == allq.count() > 0
        assert one.exceptAll(allq.select(one.columns)).count() == 0
        lw_one = D.dd_hunters(f, t, "IS", quarter=q)
        lw_all = D.dd_hunters(f, t, "IS").where(F.col("q") == q)
        assert lw_one.exceptAll(lw_all.select(lw_one.columns)).count() == 0
