from pyspark.sql import functions as F

from tallyspark.streaming import read_cells, start_refresh, weekly_cells

SRC = "/root/testdata/sf0.001"


def test_incremental_refresh_equals_batch_also_for_late_orders(spark, tmp_path):
    orders = spark.read.parquet(f"{SRC}/orders.parquet")
    customer = spark.read.parquet(f"{SRC}/customer.parquet")
    late = F.pmod(F.hash("o_orderkey"), F.lit(3)) == 0
    # the second delivery holds orders of weeks long past
    for part in (orders.where(~late), orders.where(late)):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/orders")
        q = start_refresh(spark, f"{tmp_path}/orders", customer, f"{tmp_path}/sink", f"{tmp_path}/ck")
        assert q.awaitTermination(300) and q.exception() is None
    got, want = read_cells(spark, f"{tmp_path}/sink"), weekly_cells(orders, customer)
    assert got.where(F.dayofweek("week") != 2).count() == 0
    assert got.count() == want.count() > 0 and got.exceptAll(want.select(got.columns)).count() == 0
