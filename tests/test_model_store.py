import os
import shutil

from tallyspark.sources import model, testdata

SMOKE = "/root/testdata/sf0.001"


def test_table_is_stored_once_per_application_and_equal_to_the_adapter(spark):
    first = model.materialized(spark, SMOKE, "churn_target")
    again = model.materialized(spark, SMOKE, "churn_target")
    assert first.inputFiles() == again.inputFiles()
    direct = testdata.churn_target(spark, SMOKE)
    assert first.count() == direct.count() > 0 and first.columns == direct.columns
    assert first.exceptAll(direct).count() == 0


def test_quarter_filter_reads_only_its_folder(spark):
    t = model.materialized(spark, SMOKE, "is_target")
    q = t.select("q").first()[0]
    plan = t.where(t.q == q)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(q" in plan
    assert t.where(t.q == q).exceptAll(testdata.is_target(spark, SMOKE).where(f"q = '{q}'")).count() == 0


def test_changed_input_is_seen_also_in_a_partition_folder(spark, tmp_path):
    for name in os.listdir(SMOKE):
        shutil.copy(f"{SMOKE}/{name}", tmp_path / name)
    d = str(tmp_path)
    orders = spark.read.parquet(f"{d}/orders.parquet")
    half = orders.where("o_orderkey % 2 = 0").withColumn("part", orders.o_orderkey * 0)
    os.makedirs(f"{d}/o")
    half.drop("part").coalesce(1).write.parquet(f"{d}/o/part=0")
    os.remove(f"{d}/orders.parquet")
    shutil.move(f"{d}/o", f"{d}/orders.parquet")
    before = model.materialized(spark, d, "store_history").count()
    key = model.input_version(spark, d)
    orders_all = spark.read.parquet(f"{SMOKE}/orders.parquet").where("o_orderkey % 2 = 1")
    orders_all.coalesce(1).write.mode("append").parquet(f"{d}/orders.parquet/part=0")
    assert model.input_version(spark, d) != key
    assert model.materialized(spark, d, "store_history").count() > before
