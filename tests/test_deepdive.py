import json
from collections import defaultdict

from tallyspark.operators import deepdive as D

FUNNEL = "q string, week_date date, proyecto_agrupado string, aging_category_final string, country string, hunter_email string, dias_trabajados long, stores_totales long"
TARGET = "q string, week date, proyecto string, country string, aging string, tipo_target string, target double"


def base(spark):
    import datetime
    w = [datetime.date(2026, 4, 6), datetime.date(2026, 4, 13)]
    rows = [("2026-Q2", w[0], "INBOUND", "Junior", "MX", "early@x", 5, 9),
            # One rep in two cells and two projects, once without a target; a NULL rep in two cells; a rep without stores.
            ("2026-Q2", w[1], "INBOUND", "Junior", "MX", "a@x", 5, 4), ("2026-Q2", w[1], "INBOUND", "Senior", "MX", "a@x", 2, 7),
            ("2026-Q2", w[1], "OUTBOUND", "Junior", "CO", "a@x", 1, 0), ("2026-Q2", w[1], "OUTBOUND", "Junior", "CO", "b@x", 5, 0),
            ("2026-Q2", w[1], "INBOUND", "Junior", "MX", None, 3, 2), ("2026-Q2", w[1], "INBOUND", None, "PE", None, 4, 1),
            ("2026-Q2", w[1], "INBOUND", "Junior", "PE", "c@x", 4, 1), ("2026-Q3", w[1], "INBOUND", "Junior", "MX", "a@x", 1, 1)]
    # The target of the Junior cells in MX stands twice: no day may count twice.
    goals = [("2026-Q2", w[1], "INBOUND", "MX", " 02 - junior ", "PRODUCTIVIDAD", 1.0), ("2026-Q2", w[1], "INBOUND", "MX", "02 - JUNIOR", "PRODUCTIVIDAD", 1.0),
             ("2026-Q2", w[1], "OUTBOUND", "CO", "02 - junior", "PRODUCTIVIDAD", 0.5), ("2026-Q2", w[1], "INBOUND", "MX", "02 - junior", "HC", 9.0)]
    return D.dd_calc(D.dd_base(spark.createDataFrame(rows, FUNNEL), spark.createDataFrame(goals, TARGET), "IS"), "IS")


def test_every_grain_counts_each_rep_once(spark):
    calc = base(spark)
    reps = calc.collect()
    got = D.dd_grains(calc, "IS").collect()
    for name, keys in D.GRAINS["IS"].items():
        groups = defaultdict(list)
        for r in reps:
            groups[(r.q, *[r[k] for k in keys])].append(r)
        rows = {(r.q, *[r[k] for k in keys]): r for r in got if r.block == name}
        assert set(rows) == set(groups) and len([r for r in got if r.block == name]) == len(groups)
        for g, cells in groups.items():
            r = rows[g]
            assert r.hunters == len({c.hunter_email for c in cells} - {None})
            assert r.no_target_reps == len({c.hunter_email for c in cells if c.prod_target is None} - {None})
            assert r.dias == sum(c.dias for c in cells) and r.stores == sum(c.stores for c in cells)
            assert r.gap == sum(c.stores - c.stores_tg_hunter for c in cells)
    total = next(r for r in got if r.block == "total" and r.q == "2026-Q2")
    assert (total.hunters, total.no_target_reps, total.dias) == (3, 2, 24)
    for block in D.GRAINS["IS"]:
        ranks = [(r.q, r.impact_rank, r.impacto) for r in got if r.block == block]
        assert all(a[0] != b[0] or a[2] <= b[2] for a, b in zip(sorted(ranks), sorted(ranks)[1:]))


def test_a_block_alone_equals_the_block_among_all(spark):
    calc = base(spark)
    every = D.dd_blocks(calc, "IS")
    for name, block in every.items():
        alone = D.dd_block(D.dd_grains(calc, "IS", (name,)), name, "IS")
        assert alone.columns == block.columns and alone.collect() == block.collect()


def test_payload_lists_follow_the_impact(spark):
    g = D.dd_grains(base(spark), "IS")
    payload = json.loads(D.deep_dive_json(g, "IS", "2026-04-20").where("q = '2026-Q2'").first().json)
    assert payload["week"] == "2026-04-13"
    assert [x["impact_rank"] for x in payload["aging"]] == [1, 2, 3, 4, 5]
    assert [x["impacto"] for x in payload["aging"]] == sorted(x["impacto"] for x in payload["aging"])


def test_pareto_runs_the_share_up_to_one(spark):
    p = D.country_pareto(D.dd_blocks(base(spark), "IS")["country"]).where("q = '2026-Q2'").collect()
    assert [r.impact_rank for r in p] == [1, 2, 3] and abs(p[-1].cum_share - 1) < 1e-9
    assert [r.impacto for r in p] == sorted(r.impacto for r in p)


def test_no_base_is_read_twice(spark):
    """The funnel's last week, its rows and the targets: one scan each; one shuffle by (quarter, rep) for all grains."""
    from tallyspark.sources import model
    calc = D.dd_calc(D.dd_base(model.is_funnel(spark, "/root/testdata/sf0.001"), model.is_target(spark, "/root/testdata/sf0.001"), "IS"), "IS")
    plan = D.dd_grains(calc, "IS")._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") == 3 and plan.count("Expand") == 1
