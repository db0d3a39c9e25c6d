import importlib.util

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import compare, duck

SMOKE = "/root/testdata/sf0.001"


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"q", "proyecto", "desvio", "ef_prod", "ef_hc", "ef_maturity"} <= set(df.columns)


def test_every_oracle_key_is_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 90
    present = importlib.util.find_spec("tallyspark.llm") is not None
    assert any(k.startswith("op") for k in q) == present and ("pipeline" in q) == present


@pytest.mark.parametrize("key", ["bridge_is", "bridge_ht", "section_hunting", "early_churn", "dd_is_project",
                                 "worst_offender", "qtd", "bridge_shapley", "bridge_ht_lw", "section_on_axis",
                                 "gap_concentration", "waterfall_bars", "churn_completeness", "top_drivers"])
def test_matches_duckdb_oracle_on_smoke_data(spark, key):
    got = E.queries()[key](spark, SMOKE).toPandas()
    want = duck(SMOKE).execute(E.oracle_sql()[key]).fetchdf()
    r = compare(got, want)
    assert r["cols_ok"] and r["rows"][0] == r["rows"][1] and r["match@6"], r
    assert duckdb is not None
