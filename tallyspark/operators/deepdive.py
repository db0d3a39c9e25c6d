"""Productivity deep dives (IS and HT) at the last week with actuals.

One rep-level base (rep x project x aging x country) feeds every block.
Targets are aggregated to their cell *before* the LEFT join, so duplicate
target rows cannot inflate the summed days.

All grains come from one pass over the base (``dd_grains``): inside the
partitions of one shuffle by (quarter, rep), the first row of a rep in each
group of each grain is flagged; then one GROUPING SETS aggregation sums
measures and flags. A summed flag is a distinct count, so no rep is carried
into the second, small shuffle, and nothing is expanded per distinct count.
A rep has one base row per cell, so also the rows without a rep (whose
stores and days count) are few in each quarter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from tallyspark.functions.exprs import (IS_BUCKETS, aging_key, bucket_rank, guarded_div, norm_key,
                                        perf_bucket, round_half_away, safe_div)
from tallyspark.operators.calendar import in_quarter, last_week

#: No funnel has a week before.
FIRST_DAY = "1900-01-01"
TOP_BUCKET, ZERO_BUCKET = IS_BUCKETS[-1], IS_BUCKETS[0]


def dd_base(funnel: DataFrame, target: DataFrame, levels: str = "IS", quarter: str | None = None,
            project_col: str = "proyecto_agrupado") -> DataFrame:
    """Rep-level base at each quarter's last week (kept as ``week_date``): days,
    stores and the rep's cell productivity target (NULL when the cell has none)."""
    f = in_quarter(funnel, quarter)
    # One row per quarter, so it is broadcast; a range predicate on it lets the
    # optimizer prune the folders of all other weeks at run time.
    lw = last_week(f.where(F.col("week_date") >= F.lit(FIRST_DAY).cast("date"))).withColumnRenamed("last_week", "week_date")
    f = f.join(F.broadcast(lw), ["q", "week_date"], "left_semi")
    proj = [F.col(project_col).alias("proyecto")] if levels == "IS" else []
    f = f.select("q", "week_date", *proj, F.col("aging_category_final").alias("aging"), "country",
                 "hunter_email", "dias_trabajados", "stores_totales",
                 aging_key("aging_category_final").alias("aging_norm"))
    tkeys = ["q", "week", "country"] + (["proyecto"] if levels == "IS" else [])
    t = (in_quarter(target, quarter).where(F.col("tipo_target") == "PRODUCTIVIDAD")
         .groupBy(*tkeys, norm_key("aging").alias("aging_norm"))
         .agg(F.avg("target").alias("prod_target_cell"))
         .withColumnRenamed("week", "week_date"))
    jkeys = ["q", "week_date", "country", "aging_norm"] + (["proyecto"] if levels == "IS" else [])
    j = f.join(t, jkeys, "left")
    gkeys = ["q", "week_date"] + (["proyecto"] if levels == "IS" else []) + ["aging", "country", "hunter_email"]
    return j.groupBy(*gkeys).agg(F.sum("dias_trabajados").alias("dias"), F.sum("stores_totales").alias("stores"),
                                 F.avg("prod_target_cell").alias("prod_target"))


def dd_hunters(funnel: DataFrame, target: DataFrame, levels: str = "IS", quarter: str | None = None,
               project_col: str = "proyecto_agrupado") -> DataFrame:
    """The rep-level base without its week."""
    return dd_base(funnel, target, levels, quarter, project_col).drop("week_date")


def dd_calc(base: DataFrame, levels: str = "IS") -> DataFrame:
    """Per rep: real productivity (0 without days), individual target
    stores and the performance bucket."""
    return base.select(
        "*", guarded_div("stores", "dias").alias("prod_real"),
        (F.col("dias") * F.coalesce("prod_target", F.lit(0.0))).alias("stores_tg_hunter"),
        perf_bucket("stores", "dias", "prod_target", levels).alias("bucket"))


#: The grains of the deep dives: block -> keys (besides the quarter).
GRAINS = {
    "IS": {"total": (), "project": ("proyecto",), "country": ("proyecto", "country"),
           "aging": ("proyecto", "country", "aging"), "buckets": ("proyecto", "bucket")},
    "HT": {"total": (), "aging": ("aging",), "country": ("country",), "country_aging": ("country", "aging"),
           "buckets": ("bucket",)},
}
_DIMS = {"IS": ("proyecto", "country", "aging", "bucket"), "HT": ("country", "aging", "bucket")}
# Columns of each block as the report names them: (name of the stores, with the target in stores).
_SHAPE = {"IS": {"project": ("stores_real", True)}, "HT": {n: ("stores", True) for n in ("aging", "country", "country_aging")}}


def dd_grains(calc: DataFrame, levels: str = "IS", only: tuple[str, ...] | None = None) -> DataFrame:
    """Every grain of a deep dive in one frame: ``block`` names the grain, the
    keys it sums away are NULL. hunters counts distinct reps (a NULL rep is
    none), no_target_reps those with a cell without a productivity target,
    whose stores all count as positive impact; gap is the impact unrounded;
    impact_rank orders a block's rows by impact, the worst first (ties by the
    keys). ``only`` restricts the grains."""
    grains = {n: k for n, k in GRAINS[levels].items() if only is None or n in only}
    dims = _DIMS[levels]
    has = ["week_date"] if "week_date" in calc.columns else []
    rep = F.col("hunter_email").isNotNull()
    lacks = F.col("prod_target").isNull()
    f = calc
    # The coarsest first: its shuffle by (q, rep) serves the finer ones.
    for name, keys in sorted(grains.items(), key=lambda g: len(g[1])):
        first = F.row_number().over(W.partitionBy("q", "hunter_email", *keys).orderBy(lacks.desc())) == 1
        f = f.withColumns({f"new_{name}": F.when(rep & first, 1).otherwise(0), f"lacks_{name}": F.when(rep & first & lacks, 1).otherwise(0)})
    sums = [F.max(c).alias(c) for c in has] + [
        F.sum("dias").alias("dias"), F.sum("stores").alias("stores"), F.sum("stores_tg_hunter").alias("stg"),
        F.sum(F.col("dias") * F.coalesce("prod_target", F.lit(0.0))).alias("dpt")]
    sums += [F.sum(f"{c}_{n}").alias(f"{c}_{n}") for n in grains for c in ("new", "lacks")]
    sets = [["q", *keys] for keys in grains.values()]
    g = f.groupingSets(sets, "q", *dims).agg(*sums, F.grouping_id().alias("gid"))
    bits = {n: sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in keys) for n, keys in grains.items()}

    def of_grain(value):
        return F.coalesce(*[F.when(F.col("gid") == bits[n], value(n)) for n in grains])
    gap = F.col("stores") - F.col("stg")
    g = g.select("q", of_grain(F.lit).alias("block"), *dims, *has, of_grain(lambda n: F.col(f"new_{n}")).alias("hunters"),
                 of_grain(lambda n: F.col(f"lacks_{n}")).alias("no_target_reps"), "dias", "stores",
                 round_half_away(F.col("stg"), 0).alias("stores_tg"),
                 round_half_away(safe_div("stores", "dias"), 3).alias("prod_real"),
                 round_half_away(safe_div("dpt", "dias"), 3).alias("prod_target"),
                 round_half_away(gap, 0).alias("impacto"), gap.alias("gap"))
    # The rows of one block and quarter are combinations of its dimensions, whatever the number of reps.
    w = W.partitionBy("q", "block").orderBy("impacto", *[F.col(d).asc_nulls_last() for d in dims])
    return g.withColumn("impact_rank", F.row_number().over(w).cast("bigint"))


def dd_block(grains: DataFrame, name: str, levels: str = "IS") -> DataFrame:
    """The rows of one block with its columns, ordered by impact (buckets: in their own order)."""
    stores_name, with_tg = _SHAPE[levels].get(name, ("stores", False))
    rank = bucket_rank("bucket", levels).alias("bucket_rank") if name == "buckets" else F.col("impact_rank")
    b = grains.where(F.col("block") == name).select(
        "q", *GRAINS[levels][name], "hunters", "no_target_reps", "dias", F.col("stores").alias(stores_name),
        *(["stores_tg"] if with_tg else []), "prod_real", "prod_target", "impacto", rank)
    return b.orderBy("q", *(["proyecto"] if name == "buckets" and levels == "IS" else []), b.columns[-1])


def dd_blocks(calc: DataFrame, levels: str = "IS") -> dict[str, DataFrame]:
    """Every block, from one frame of grains."""
    g = dd_grains(calc, levels)
    return {n: dd_block(g, n, levels) for n in GRAINS[levels] if n != "total"}


def _of(name: str, value):
    return F.when(F.col("block") == name, value)


# ------------------------------------------------------------------------ IS
def _kpis_is() -> tuple[list, list]:
    """The aggregates behind the KPIs and the KPIs over them."""
    parts = [F.max(_of("total", F.col("gap"))).alias("_t")] + [
        F.max(_of("project", F.when(F.col("proyecto") == p, F.col("gap")))).alias(c) for p, c in (("INBOUND", "_i"), ("OUTBOUND", "_o"))]
    t = round_half_away("_t", 0)
    i, o = (F.coalesce(round_half_away(c, 0), F.lit(0.0)) for c in ("_i", "_o"))
    return parts, [t.alias("total_gap"), i.alias("inbound_gap"), o.alias("outbound_gap"),
                   round_half_away(safe_div(F.abs(i), F.abs(t)) * 100, 1).alias("inbound_share"),
                   round_half_away(safe_div(F.abs(o), F.abs(t)) * 100, 1).alias("outbound_share")]


def dd_is_kpis(grains: DataFrame) -> DataFrame:
    """Total / inbound / outbound gap and shares |part| / |total| x 100."""
    parts, kpis = _kpis_is()
    return grains.where(F.col("block").isin("total", "project")).groupBy("q").agg(*parts).select("q", *kpis)


def country_pareto(country_block: DataFrame) -> DataFrame:
    """Impact by country summed over projects, the worst first: rank, share of
    the summed absolute impacts and that share run up to the rank (windows over
    the countries of one quarter)."""
    c = country_block.groupBy("q", "country").agg(F.sum("impacto").alias("impacto"))
    w = W.partitionBy("q").orderBy("impacto", F.col("country").asc_nulls_last())
    size, all_ = F.abs(F.col("impacto")), F.sum(F.abs("impacto")).over(W.partitionBy("q"))
    c = c.select("q", "country", "impacto", F.row_number().over(w).cast("bigint").alias("impact_rank"),
                 round_half_away(safe_div(size, all_), 6).alias("share"),
                 round_half_away(safe_div(F.sum(size).over(w.rowsBetween(W.unboundedPreceding, 0)), all_), 6).alias("cum_share"))
    return c.orderBy("q", "impact_rank")


def top_drivers(aging_block: DataFrame, k: int = 12) -> DataFrame:
    """The ``k`` most negative project x country x aging cells per quarter
    (ties broken by the keys); label = project prefix · country · aging."""
    label = F.concat_ws(" · ", F.substring("proyecto", 1, 2), F.col("country"), F.col("aging"))
    return aging_block.where(F.col("impact_rank") <= k).select(
        "q", F.col("impact_rank").alias("rank"), label.alias("label"), "proyecto", "country", "aging", "hunters", "dias",
        "stores", "prod_real", "prod_target", "impacto")


def highlights_is(grains: DataFrame) -> DataFrame:
    """Worst project, worst country (over projects), OB reps with 0 stores."""
    name = F.when(F.col("block") == "country", F.col("country")).otherwise(F.col("proyecto"))
    g = (grains.where(F.col("block").isin("project", "country", "buckets")).groupBy("q", "block", name.alias("name"), "bucket")
         .agg(F.sum("impacto").alias("impacto"), F.sum("hunters").alias("hunters")))
    worst = F.struct("impacto", "name")
    zero = (F.col("name") == "OUTBOUND") & (F.col("bucket") == ZERO_BUCKET)
    h = g.groupBy("q").agg(F.min(_of("project", worst)).alias("p"), F.min(_of("country", worst)).alias("c"),
                           F.max(_of("buckets", F.when(zero, F.col("hunters")))).alias("z"))
    return h.select("q", F.col("p.name").alias("worst_project"), F.col("p.impacto").alias("worst_project_impacto"),
                    F.col("c.name").alias("worst_country"), F.col("c.impacto").alias("worst_country_impacto"),
                    F.coalesce("z", F.lit(0)).cast("bigint").alias("ob_zero_hunters"))


# ------------------------------------------------------------------------ HT
def _kpis_ht() -> tuple[list, list]:
    names = {"impacto": "total_gap", "prod_real": "prod_real", "prod_target": "prod_target", "stores": "stores_real",
             "stores_tg": "stores_tg", "hunters": "hunters", "dias": "dias"}
    return [F.max(_of("total", F.struct(*names))).alias("_k")], [F.col(f"_k.{c}").alias(name) for c, name in names.items()]


def dd_ht_kpis(grains: DataFrame) -> DataFrame:
    parts, kpis = _kpis_ht()
    return grains.where(F.col("block") == "total").groupBy("q").agg(*parts).select("q", *kpis)


def highlights_ht(grains: DataFrame) -> DataFrame:
    """Best aging, worst country (NULL when none is negative), and reps and
    impact in the top and zero buckets."""
    def bucket(name: str, value: str):
        return F.sum(_of("buckets", F.when(F.col("bucket") == name, F.col(value))))
    h = grains.groupBy("q").agg(
        F.max(_of("aging", F.struct("impacto", "aging"))).alias("a"), F.min(_of("country", F.struct("impacto", "country"))).alias("c"),
        bucket(TOP_BUCKET, "hunters").alias("top_hunters"), bucket(TOP_BUCKET, "impacto").alias("top_impacto"),
        bucket(ZERO_BUCKET, "hunters").alias("zero_hunters"), bucket(ZERO_BUCKET, "impacto").alias("zero_impacto"))
    below = F.col("c.impacto") < 0
    return h.select("q", F.col("a.aging").alias("best_aging"), F.col("a.impacto").alias("best_aging_impacto"),
                    F.when(below, F.col("c.country")).alias("worst_country"), F.when(below, F.col("c.impacto")).alias("worst_country_impacto"),
                    "top_hunters", "top_impacto", "zero_hunters", "zero_impacto")


# ------------------------------------------------------------ reconciliation
def dd_reconciliation(grains: dict[str, DataFrame], tolerance: float = 0.01) -> DataFrame:
    """Each block's summed impact against the total gap of its deep dive
    (``grains``: dive -> frame of grains); flag > 1 %."""
    parts = [g.groupBy("q", "block").agg(F.sum("impacto").alias("block_sum")).withColumn("dive", F.lit(name)) for name, g in grains.items()]
    s = reduce(lambda a, b: a.unionByName(b), parts)
    total = F.max(_of("total", F.col("block_sum"))).over(W.partitionBy("q", "dive"))
    j = s.withColumn("total_gap", total).where(F.col("block") != "total")
    rel = safe_div(F.abs(F.col("block_sum") - F.col("total_gap")), F.abs(F.col("total_gap")))
    return j.select("dive", "q", "block", "block_sum", "total_gap",
                    (F.col("block_sum") - F.col("total_gap")).alias("diff"),
                    round_half_away(rel, 6).alias("diff_rel"),
                    F.coalesce(rel <= tolerance, F.col("block_sum") == F.col("total_gap")).alias("ok"))


# ---------------------------------------------------------------- JSON sink
def deep_dive_json(grains: DataFrame, levels: str, generated: str) -> DataFrame:
    """One JSON payload per quarter: week, generated date, kpis and one
    array per block, ordered by impact, from one aggregation of the grains.
    A block holds one row per key combination of a quarter's last week, so
    its array is bounded by the dimensions (countries x agings x projects),
    not by the facts."""
    blocks = {n: dd_block_columns(n, levels) for n in GRAINS[levels] if n != "total"}
    parts, kpis = _kpis_is() if levels == "IS" else _kpis_ht()
    g = grains.withColumn("bucket_rank", bucket_rank("bucket", levels))
    arrays = [F.array_sort(F.collect_list(_of(n, F.struct(*cols)))).alias(n) for n, cols in blocks.items()]
    out = g.groupBy("q").agg(F.max(F.date_format("week_date", "yyyy-MM-dd")).alias("week"), *arrays, *parts)
    payload = F.struct("week", F.lit(generated).alias("generated"), F.struct(*kpis).alias("kpis"), *blocks)
    # Fields without a value are written as null.
    return out.select("q", F.to_json(payload, {"ignoreNullFields": "false"}).alias("json"))


def dd_block_columns(name: str, levels: str) -> list:
    """A block's payload columns: its rank first, so that sorting the rows orders them by it."""
    stores_name, with_tg = _SHAPE[levels].get(name, ("stores", False))
    keys = list(GRAINS[levels][name])
    lead = [*keys[:-1], "bucket_rank", "bucket"] if name == "buckets" else ["impact_rank", *keys]
    return [F.col(c) for c in lead] + [F.col("hunters"), F.col("no_target_reps"), F.col("dias"), F.col("stores").alias(stores_name)] + (
        [F.col("stores_tg")] if with_tg else []) + [F.col("prod_real"), F.col("prod_target"), F.col("impacto")]
