"""The frames of the report sections come from stored files."""
from tallyspark.plans import q_report

SMOKE = "/root/testdata/sf0.001"


def test_report_sections_are_unpivoted_from_stored_frames(spark):
    frames = q_report._sections(spark, SMOKE)
    assert all("tallyspark-stored" in p for f in frames.values() for p in f.inputFiles())
    assert frames["early_churn_m1"] is frames["early_churn_m3"] and frames["hunting"].count() > 0
