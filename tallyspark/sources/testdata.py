"""Adapter: derive the model tables of the analytics domain from the
TPC-H-style test tables.

The test warehouse has no rep funnel, targets, EAV funnel, churn or store
detail tables, so each one is derived from the given tables by a rule
(FIXTURES.md has the model schemas). Everything is lazy DataFrame code:
facts are aggregated *before* they are joined to dimensions, and only the
two fixed-size dimensions (nation: 25 rows, region: 5 rows) are broadcast.
Supplier and customer grow with the data, so their joins are left to the
planner (AQE may still pick a broadcast once it has measured them).

Derived attributes use key arithmetic (``s_suppkey % 7`` etc.). That only
*labels* rows; no rule drops rows from the inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.exprs import quarter_label, week_start
from tallyspark.sources.tables import read_table

# ---------------------------------------------------------------------------
# Fixed values of the adapter (the DuckDB oracle repeats them verbatim).
# Market segment -> (ELC team, ELC channel group).
SEGMENT_CHANNEL = {
    "AUTOMOBILE": ("HUNTING", "HUNTING"),
    "BUILDING": ("INSIDE SALES", "INSIDE SALES OUTBOUND"),
    "FURNITURE": ("INSIDE SALES", "INSIDE SALES INBOUND"),
    "HOUSEHOLD": ("SELF-ONBOARDING", "SELF-ONBOARDING"),
    "MACHINERY": ("BRAND EXPANSION", "BRAND EXPANSION"),
}
# Market segment -> churn CHANNEL_AM (mixed case; "Partners" is unmapped).
SEGMENT_CHURN_CHANNEL = {
    "AUTOMOBILE": "Hunting",
    "BUILDING": "Inside Sales",
    "FURNITURE": "Brand Expansion",
    "HOUSEHOLD": "Self-Onboarding",
    "MACHINERY": "Partners",
}
# Order status -> churn age.
STATUS_AGE = {"F": "M1", "O": "M2", "P": "M3"}
# Target labels of the aging index 1..3 (IS targets use this mixed case).
IS_AGING_TARGET = ["01 - New Entry", "02 - Junior", "03 - Senior"]
HT_AGING_TARGET = ["01 - new entry", "02 - junior", "03 - senior"]
# Churn-target channels, index 1..5.
CHURN_TARGET_CHANNELS = ["HUNTING", "IS", "SOB", "BE", "TOTAL"]
ELC_COUNT_TYPES = ["CREATED", "AVAILABLE", "ACTIVE", "PERFECT STORE", "HANDOFF", "HANDOFF_3",
                   "HANDOFF_7", "HANDOFF_28", "LOG_7", "LOG_28", "ORDER_7", "ORDER_28"]
ELC_STOCK_TYPES = ["TOTAL AVAILABLE", "TOTAL ACTIVE"]
#: Rows of lineitem that one task aggregates by supplier and week.
SUPPLIER_ROWS = 1 << 19
ELC_AVG_TYPES = ["AVG_DIAS_HANDOFF", "AVG_DIAS_LOG", "AVG_DIAS_ORDER"]
# ---------------------------------------------------------------------------


def _nation(spark: SparkSession, d: str) -> DataFrame:
    # 25 rows by definition of the schema: a proven size bound.
    return F.broadcast(read_table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey"))


def _region(spark: SparkSession, d: str) -> DataFrame:
    return F.broadcast(read_table(spark, d, "region").select("r_regionkey", "r_name"))


def _case(col, mapping: dict, default=None):
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr if default is None else expr.otherwise(F.lit(default))


def _count_if(cond):
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


# ---------------------------------------------------------------- rep funnel
def supplier_week(spark: SparkSession, d: str) -> DataFrame:
    """lineitem -> (supplier, week): days worked and stores of each project
    (stores NULL where the project has no row) and days worked on any.

    A day counts once however many rows it has, so a week's days are a bit
    each: one aggregation on fixed-width keys, without a step per day. Rows
    are dealt by their key first, into parts of at most some SUPPLIER_ROWS rows:
    a hash table before the shuffle would hold most rows of a scan task, since
    few of them share a key. Rows without a supplier join none and stay out."""
    li = read_table(spark, d, "lineitem")
    out = F.coalesce(F.col("l_linestatus") == "O", F.lit(False))
    bit = F.expr("shiftleft(1, coalesce(weekday(to_date(l_shipdate)), 7))")
    rows = li.where(F.col("l_suppkey").isNotNull()).select(
        "l_suppkey", week_start(F.to_date("l_shipdate")).alias("week_date"), out.alias("out"),
        F.when(F.col("l_discount") < 0.09, bit).otherwise(F.lit(0)).alias("bit"),
        F.when(F.col("l_returnflag") != "R", F.lit(1)).otherwise(F.lit(0)).alias("made"))
    n = max(spark.sparkContext.defaultParallelism, -(-li.count() // SUPPLIER_ROWS))

    def worked(project):
        return F.bit_or(F.when(project, F.col("bit")).otherwise(F.lit(0)))

    out = F.col("out")
    wk = rows.repartition(n, "l_suppkey", "week_date").groupBy("l_suppkey", "week_date").agg(
        worked(out).alias("o"), worked(~out).alias("i"), F.sum(F.when(out, F.col("made"))).alias("out_stores"), F.sum(F.when(~out, F.col("made"))).alias("in_stores"))

    def days(mask):
        return F.bit_count(mask).cast("bigint")

    return wk.select("l_suppkey", "week_date", days(F.col("o")).alias("out_days"), "out_stores", days(F.col("i")).alias("in_days"), "in_stores",
                     days(F.col("o").bitwiseOR(F.col("i"))).alias("days"))


def _attach_rep(week_facts: DataFrame, spark: SparkSession, d: str, balanced: bool) -> DataFrame:
    """The facts with their quarter and rep. ``balanced``: dealt by week in
    parts of like size and sorted, as the stored funnels are, while the rows
    are narrow; what follows from their columns is added after that."""
    sup = read_table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    k = F.col("s_suppkey")
    aging = (F.when(k % 10 == 9, F.lit("Other")).when(k % 3 == 0, F.lit("New Entry"))
             .when(k % 3 == 1, F.lit("Junior")).otherwise(F.lit("Senior")))
    rows = (week_facts.join(sup, F.col("l_suppkey") == k)
            .join(_nation(spark, d), F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", "s_name", "n_name", *[c for c in week_facts.columns if c != "l_suppkey"]))
    if balanced:
        rows = rows.hint("rebalance", "week_date")
    rows = rows.select(quarter_label("week_date").alias("q"), "*")
    if balanced:
        rows = rows.sortWithinPartitions("q", "week_date")
    return rows.select("*", F.col("n_name").alias("country"), aging.alias("aging_category_final"),
                       F.when(k % 31 != 5, F.col("s_name")).alias("hunter_email"),
                       F.when(k % 7 == 0, F.lit(0)).otherwise(F.lit(1)).alias("hc"))


def is_funnel(spark: SparkSession, d: str, weeks: DataFrame | None = None, balanced: bool = False) -> DataFrame:
    """IS rep funnel: rep x week x country x aging x project. ``weeks`` may
    hand in ``supplier_week`` where it is stored."""
    weeks = supplier_week(spark, d) if weeks is None else weeks
    parts = F.array(*[F.struct(F.lit(out).alias("out"), F.col(f"{p}_days").alias("dias_trabajados"), F.col(f"{p}_stores").alias("stores_totales"))
                      for out, p in ((True, "out"), (False, "in"))])
    wk = weeks.select("l_suppkey", "week_date", F.inline(parts)).where(F.col("stores_totales").isNotNull())
    proyecto = F.when(F.col("out"), F.lit("OUTBOUND")).otherwise(F.lit("INBOUND"))
    return _attach_rep(wk, spark, d, balanced).select(
        "q", "week_date", "country", proyecto.alias("proyecto"), proyecto.alias("proyecto_agrupado"),
        "aging_category_final", "hunter_email", "hc", "dias_trabajados", "stores_totales")


def ht_funnel(spark: SparkSession, d: str, weeks: DataFrame | None = None, balanced: bool = False) -> DataFrame:
    """HT rep funnel: rep x week x country x aging (no project)."""
    weeks = supplier_week(spark, d) if weeks is None else weeks
    zero = F.lit(0)
    wk = weeks.select("l_suppkey", "week_date", F.col("days").alias("dias_trabajados"),
                      (F.coalesce("out_stores", zero) + F.coalesce("in_stores", zero)).alias("stores_totales"))
    return _attach_rep(wk, spark, d, balanced).select(
        "q", "week_date", "country", "aging_category_final", "hunter_email", "hc",
        "dias_trabajados", "stores_totales")


# ------------------------------------------------------------------- targets
def order_nation_weeks(spark: SparkSession, d: str) -> DataFrame:
    """Distinct (week, nation) with orders; the grain of the rep targets."""
    o = read_table(spark, d, "orders").select("o_custkey", week_start("o_orderdate").alias("week"))
    c = read_table(spark, d, "customer").select("c_custkey", "c_nationkey")
    g = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
         .select("week", F.col("c_nationkey").alias("nk")).distinct())
    return (g.join(_nation(spark, d), F.col("nk") == F.col("n_nationkey"))
            .select("week", "nk", F.col("n_name").alias("country"), F.weekofyear("week").alias("w")))


def _target_rows(cells: DataFrame, label, mult, extra_cols: list[str]) -> DataFrame:
    nk, i, w = F.col("nk"), F.col("i"), F.col("w")
    hc = (F.lit(1) + (nk + i) % 2).cast("double")
    prod = F.when((i == 2) & ((nk + w) % 13 == 0), F.lit(0.0)).otherwise(F.lit(0.5) + F.lit(0.125) * i)
    # Where the productivity target is 0 the official stores follow from no headcount, so S0 and the official target differ.
    stores = F.when(prod == 0, F.lit(1.5)).otherwise(hc * prod * mult)

    def kind(name, value):
        return F.struct(F.lit(name).alias("tipo_target"), value.cast("double").alias("target"))

    base = [kind("HC", hc), kind("PRODUCTIVIDAD", prod), kind("STORES", stores)]
    # Headcounts (averaged) and stores (summed) stand twice in some cells.
    kinds = (F.when((nk + w) % 11 == 0, F.array(*base, kind("HC", hc))).when((nk + w) % 17 == 0, F.array(*base, kind("STORES", stores)))
             .otherwise(F.array(*base)))
    return (cells.where((nk + i + w) % 7 != 0)
            .select("*", F.explode(kinds).alias("k"))
            .select(quarter_label("week").alias("q"), "week", "country", *extra_cols,
                    label.alias("aging"), "k.tipo_target", "k.target"))


def is_target(spark: SparkSession, d: str, weeks: DataFrame | None = None) -> DataFrame:
    """IS long targets: (q, week, country, proyecto, aging, tipo_target, target).
    ``weeks`` may hand in ``order_nation_weeks`` where it is stored."""
    cells = ((order_nation_weeks(spark, d) if weeks is None else weeks)
             .select("*", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("i"))
             .select("*", F.explode(F.array(F.lit("OUTBOUND"), F.lit("INBOUND"))).alias("proyecto")))
    base = _case(F.col("i"), dict(zip([1, 2, 3], IS_AGING_TARGET)))
    label = F.when(F.col("nk") % 2 == 1, F.concat(F.lit(" "), F.upper(base), F.lit(" "))).otherwise(base)
    mult = (F.lit(1.0) + (F.col("w") % 4) * F.lit(0.5)
            + F.when(F.col("proyecto") == "INBOUND", F.lit(0.25)).otherwise(F.lit(0.0)))
    return _target_rows(cells, label, mult, ["proyecto"])


def ht_target(spark: SparkSession, d: str, weeks: DataFrame | None = None) -> DataFrame:
    """HT long targets: (q, week, country, aging, tipo_target, target)."""
    cells = ((order_nation_weeks(spark, d) if weeks is None else weeks)
             .select("*", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("i")))
    label = _case(F.col("i"), dict(zip([1, 2, 3], HT_AGING_TARGET)))
    mult = F.lit(1.0) + (F.col("w") % 4) * F.lit(0.5)
    return _target_rows(cells, label, mult, [])


# ------------------------------------------------------------- ELC EAV funnel
def elc_funnel(spark: SparkSession, d: str) -> DataFrame:
    """Weekly EAV funnel (q, week, country, team, channel_group, type, metric)."""
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                              "o_totalprice", "o_orderpriority")
    c = read_table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    key, prio = F.col("o_orderkey"), F.col("o_orderpriority")

    def avg_days(m):  # quarter-day resolution keeps the metric exact
        return F.floor(F.avg(key % m) * 4) / 4

    cell = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
            .groupBy(week_start("o_orderdate").alias("week"), "c_nationkey", "c_mktsegment")
            .agg(F.count(F.lit(1)).alias("CREATED"),
                 _count_if(prio != "5-LOW").alias("AVAILABLE"),
                 _count_if(prio.isin("1-URGENT", "2-HIGH", "3-MEDIUM")).alias("ACTIVE"),
                 _count_if(F.col("o_totalprice") > 300000).alias("PERFECT STORE"),
                 _count_if(key % 8 != 7).alias("HANDOFF"),
                 _count_if(key % 4 == 0).alias("HANDOFF_3"),
                 _count_if(key % 4 <= 1).alias("HANDOFF_7"),
                 _count_if(key % 4 <= 2).alias("HANDOFF_28"),
                 _count_if(key % 5 <= 1).alias("LOG_7"),
                 _count_if(key % 5 <= 3).alias("LOG_28"),
                 _count_if(key % 6 == 0).alias("ORDER_7"),
                 _count_if(key % 3 == 0).alias("ORDER_28"),
                 avg_days(28).alias("AVG_DIAS_HANDOFF"),
                 avg_days(21).alias("AVG_DIAS_LOG"),
                 avg_days(14).alias("AVG_DIAS_ORDER")))
    # Stocks: running totals of the flows per (nation, segment), partitioned
    # window (never a global one).
    from pyspark.sql import Window as W
    run = (W.partitionBy("c_nationkey", "c_mktsegment").orderBy("week")
           .rowsBetween(W.unboundedPreceding, W.currentRow))
    cell = (cell.withColumn("TOTAL AVAILABLE", F.sum("AVAILABLE").over(run))
                .withColumn("TOTAL ACTIVE", F.sum("ACTIVE").over(run)))
    seg = F.col("c_mktsegment")
    team = _case(seg, {k: v[0] for k, v in SEGMENT_CHANNEL.items()})
    group = _case(seg, {k: v[1] for k, v in SEGMENT_CHANNEL.items()})
    types = ELC_COUNT_TYPES + ELC_STOCK_TYPES + ELC_AVG_TYPES
    eav = F.explode(F.array(*[F.struct(F.lit(t).alias("type"), F.col(f"`{t}`").cast("double").alias("metric"))
                              for t in types])).alias("e")
    out = (cell.join(_nation(spark, d), F.col("c_nationkey") == F.col("n_nationkey"))
           .select(quarter_label("week").alias("q"), "week", F.col("n_name").alias("country"),
                   team.alias("team"), group.alias("channel_group"), eav)
           .select("q", "week", "country", "team", "channel_group", "e.type", "e.metric"))
    # Sparse EAV: a flow type with no event in a cell has no row.
    return out.where(~F.col("type").isin(*ELC_COUNT_TYPES) | (F.col("metric") != 0))


def elc_target(spark: SparkSession, d: str, weeks: DataFrame | None = None) -> DataFrame:
    """ELC targets on the lineitem week axis (runs past the last order week).
    ``weeks`` may hand in ``supplier_week`` where it is stored."""
    if weeks is None:
        sw = read_table(spark, d, "lineitem").select("l_suppkey", week_start("l_shipdate").alias("week")).distinct()
    else:
        sw = weeks.select("l_suppkey", F.col("week_date").alias("week"))
    sup = read_table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    g = (sw.join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
         .select("week", F.col("s_nationkey").alias("nk")).distinct()
         .join(_nation(spark, d), F.col("nk") == F.col("n_nationkey")))
    chans = F.array(*[F.struct(F.lit(i).alias("c"), F.lit(t).alias("team"), F.lit(cg).alias("channel_group"))
                      for i, (t, cg) in enumerate(SEGMENT_CHANNEL.values())])
    nk, w = F.col("nk"), F.weekofyear("week")
    cells = g.select("week", "nk", F.col("n_name").alias("country"), w.alias("w"), F.explode(chans).alias("ch"))
    c = F.col("ch.c")
    kinds = F.array(
        F.struct(F.lit("AVAILABLE").alias("tipo_target"), (F.lit(1) + (nk + c + F.col("w")) % 4).cast("double").alias("target")),
        F.struct(F.lit("ACTIVE").alias("tipo_target"), ((nk + 2 * c + F.col("w")) % 3).cast("double").alias("target")))
    return (cells.select("*", F.explode(kinds).alias("k"))
            .select(quarter_label("week").alias("q"), "week", "country", "ch.team", "ch.channel_group",
                    "k.tipo_target", "k.target"))


# --------------------------------------------------------------------- churn
def churn_detail(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    c = read_table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    agg = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
           .groupBy(week_start("o_orderdate").alias("week"), "c_nationkey", "o_orderstatus", "c_mktsegment")
           .agg(_count_if(F.col("o_totalprice") < 50000).alias("churn"), F.count(F.lit(1)).alias("total_store")))
    nk = F.col("c_nationkey")
    country = F.when(nk == 3, F.lit("BR")).when(nk == 24, F.lit(None).cast("string")).otherwise(F.col("n_name"))
    return (agg.join(_nation(spark, d), nk == F.col("n_nationkey"))
            .select("week", country.alias("country"),
                    _case(F.col("o_orderstatus"), STATUS_AGE).alias("age"),
                    _case(F.col("c_mktsegment"), SEGMENT_CHURN_CHANNEL).alias("channel_am"),
                    "churn", "total_store"))


def churn_target(spark: SparkSession, d: str) -> DataFrame:
    """Weekly churn targets per channel; week is a string (cast on read)."""
    wk = read_table(spark, d, "orders").select(week_start("o_orderdate").alias("week")).distinct()
    chans = F.array(*[F.struct(F.lit(i).alias("c"), F.lit(n).alias("channel_am"))
                      for i, n in enumerate(CHURN_TARGET_CHANNELS, start=1)])
    cells = (wk.select("week", F.weekofyear("week").alias("w"), F.explode(chans).alias("ch"))
             .select("*", F.explode(F.array(F.lit("TOTAL"), F.lit("CO"))).alias("country")))
    w, c = F.col("w"), F.col("ch.c")
    off = F.when(F.col("country") == "CO", F.lit(0.5)).otherwise(F.lit(0.0))
    m1 = F.when((c == 4) & (w % 10 == 7), F.lit(0.75)).otherwise(((w * 3 + c * 5) % 64 + 32) / F.lit(1024.0))
    m2 = ((w * 5 + c * 3) % 64 + 40) / F.lit(1024.0)
    m3 = ((w * 7 + c) % 64 + 48) / F.lit(1024.0)
    return (cells.where((w + c) % 9 != 0)
            .select(F.date_format("week", "yyyy-MM-dd").alias("week"), "country", "ch.channel_am",
                    (m1 + off).alias("TARGET_%CHURN_M1"), (m2 + off).alias("TARGET_%CHURN_M2"),
                    (m3 + off).alias("TARGET_%CHURN_M3")))


# -------------------------------------------------------------- store detail
def store_detail(spark: SparkSession, d: str) -> DataFrame:
    """Per-store portfolio detail (the SILVER layer)."""
    o = read_table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderstatus")
    per = (o.groupBy("o_custkey")
           .agg(F.to_date(F.min("o_orderdate")).alias("first_order"),
                _count_if(F.col("o_orderstatus") == "F").alias("n_done"),
                _count_if(F.col("o_orderstatus") == "P").alias("n_partner")))
    cu = read_table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    k = F.col("c_custkey")
    envio = F.coalesce(F.col("first_order"), F.lit("1995-01-01").cast("date"))
    login = F.when(F.col("c_acctbal") < 0, F.lit(None).cast("date")).otherwise(
        F.date_add(envio, (k % 3).cast("int")))
    return (cu.join(per, k == F.col("o_custkey"), "left")
            .join(_nation(spark, d), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(_region(spark, d), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(k.alias("store_id"), F.col("n_name").alias("hunter_"), F.col("r_name").alias("coordinador"),
                    F.col("c_mktsegment").alias("channel"),
                    F.concat(F.lit("L"), (k % 50).cast("string")).alias("razon_social"),
                    F.concat(F.lit("B"), (k % 20).cast("string")).alias("brand_name"),
                    F.concat(F.lit("A"), (k % 200).cast("string")).alias("adress"),
                    (((k * 37) % 101) / F.lit(100.0)).alias("av_0_28"),
                    (((k * 41) % 101) / F.lit(100.0)).alias("av_last_week"),
                    (((k * 43) % 101) / F.lit(100.0)).alias("av_last_2week"),
                    (((k * 47) % 101) / F.lit(100.0)).alias("av_l4w"),
                    F.coalesce(F.col("n_partner"), F.lit(0).cast("bigint")).alias("orders_cancel_partner_0_28"),
                    F.coalesce(F.col("n_done"), F.lit(0).cast("bigint")).alias("orders_0_28"),
                    F.when(F.col("n_done") > 0, F.lit("COMPLETED")).otherwise(F.lit("PENDING")).alias("handoff"),
                    envio.alias("fecha_envio_de_credenciales"), login.alias("first_login")))


def store_history(spark: SparkSession, d: str) -> DataFrame:
    """Store x day performance rows (one per order)."""
    return (read_table(spark, d, "orders")
            .select(F.col("o_custkey").alias("external_store_id"), F.to_date("o_orderdate").alias("day_date"),
                    week_start("o_orderdate").alias("week_date"), F.col("o_orderkey").alias("order_id"),
                    F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("order_value")))


def store_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Snapshots of a store's stock with the time they were loaded: days to
    weeks after the snapshot day (late) and several for one day (repeated)."""
    later = F.make_dt_interval((F.col("l_partkey") % 30).cast("int"), F.lit(0), (F.col("l_orderkey") % 1440).cast("int"), F.lit(0))
    return (read_table(spark, d, "lineitem")
            .select(F.col("l_suppkey").alias("store_id"), F.to_date("l_shipdate").alias("day"),
                    (F.to_date("l_shipdate").cast("timestamp") + later).alias("loaded_at"),
                    (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("load_id"),
                    F.col("l_quantity").cast("double").alias("stock"), F.col("l_linestatus").alias("status")))
