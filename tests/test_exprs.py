from pyspark.sql import functions as F

from tallyspark.functions.exprs import guarded_div, null_div, perf_bucket, round_half_away, safe_div


def _one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_round_half_away(spark):
    assert _one(spark, round_half_away(F.lit(2.5), 0)) == 3.0
    assert _one(spark, round_half_away(F.lit(-2.5), 0)) == -3.0
    assert _one(spark, round_half_away(F.lit(0.125), 2)) == 0.13
    v = _one(spark, round_half_away(F.lit(-0.0001), 2))
    assert v == 0.0 and str(v) == "0.0"  # no negative zero
    # a sum that lands one ulp below a tie still rounds away from zero
    assert _one(spark, round_half_away(F.lit(0.1 + 0.2 + 0.15), 1)) == 0.5
    assert _one(spark, round_half_away(F.lit(None).cast("double"), 2)) is None
    # one rule for every size, also beyond the range of a long
    assert _one(spark, round_half_away(F.lit(9.0e9 + 0.25), 1)) == 9.0e9 + 0.3
    assert _one(spark, round_half_away(F.lit(1.0e22), 6)) == 1.0e22 and _one(spark, round_half_away(F.lit(-3.0e17), 3)) == -3.0e17


def test_division_guards(spark):
    assert _one(spark, safe_div(F.lit(1), F.lit(0))) is None          # NULLIF
    assert _one(spark, guarded_div(F.lit(1), F.lit(0))) == 0.0        # 0, not NULL
    assert _one(spark, null_div(F.lit(1), F.lit(-1))) is None         # NULL when <= 0
    assert _one(spark, guarded_div(F.lit(3), F.lit(2))) == 1.5


def test_perf_bucket_rules(spark):
    rows = [(0.0, 5.0, 1.0), (1.0, 5.0, 1.0), (3.0, 5.0, 1.0), (4.5, 5.0, 1.0), (6.0, 5.0, 1.0),
            (3.0, 5.0, None), (3.0, 0.0, 1.0), (3.0, 5.0, 0.0)]
    df = spark.createDataFrame(rows, "stores double, dias double, pt double")
    out = [r["b"] for r in df.select(perf_bucket("stores", "dias", "pt", "IS").alias("b")).collect()]
    assert out == ["00 stores", "<50% target prod", "50-80% target prod", "80-100% target prod",
                   ">= target prod",
                   # no target / zero days / zero target: a rep with stores lands in ">= target"
                   ">= target prod", ">= target prod", ">= target prod"]
    ht = [r["b"] for r in df.select(perf_bucket("stores", "dias", "pt", "HT").alias("b")).collect()]
    assert ht[:5] == ["00 stores", "<50% target prod", "50-80% target prod", "50-80% target prod",
                      ">= target prod"]
