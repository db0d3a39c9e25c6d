"""Portfolio quality (fraud) metrics: GOLD aggregates derived from the
per-store SILVER detail, rates, rankings, worst offenders and store lists.

Rates are always recomputed from summed counts (never averaged). The worst
offender per rep is an *aggregation* (min of a struct ordered by
no-login desc, total desc, name asc) rather than a window, so a rep holding
a large share of all stores is still combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.exprs import round_half_away, safe_div
from tallyspark.functions.ordering import positions
from tallyspark.session import stored

ENTITIES = ["razon_social", "brand_name", "adress"]
COUNTS = ["total_store", "store_sin_fl", "store_sin_orders", "store_sin_handoff", "churn", "total_store_churn"]


def _flags(silver: DataFrame) -> DataFrame:
    no_login = F.col("first_login").isNull()
    logged = F.col("first_login").isNotNull()
    one = lambda c: F.when(c, F.lit(1)).otherwise(F.lit(0))
    return silver.select(
        "*", F.lit(1).alias("total_store"), one(no_login).alias("store_sin_fl"),
        one(F.col("orders_0_28") == 0).alias("store_sin_orders"),
        one(F.col("handoff") != "COMPLETED").alias("store_sin_handoff"),
        one(logged & (F.col("orders_0_28") == 0)).alias("churn"),
        one(logged).alias("total_store_churn"))


def _rates(df: DataFrame) -> list:
    return [safe_div("store_sin_fl", "total_store").alias("store_sin_login_rate"),
            safe_div("store_sin_orders", "total_store").alias("pct_sin_orders"),
            safe_div("store_sin_handoff", "total_store").alias("pct_sin_handoff"),
            safe_div("churn", "total_store_churn").alias("churn_rate")]


def quality_gold(silver: DataFrame, keys: tuple[str, ...] = ("hunter_", "coordinador", "channel")) -> DataFrame:
    """GOLD counts per (hunter, coordinator, channel) plus recomputed rates."""
    g = _flags(silver).groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(c) for c in COUNTS])
    return g.select("*", *_rates(g))


def hunter_ranking(gold: DataFrame) -> DataFrame:
    """Reps ranked by stores without first login: absolute counts summed
    over coordinators/channels, rates recomputed from the sums, ``rank`` from 1.
    The reps are as many as the data holds, so the rank comes from range
    partitions (``positions``), not from a window over all of them."""
    g = gold.groupBy("hunter_").agg(*[F.sum(c).cast("bigint").alias(c) for c in COUNTS])
    g = positions(stored(g.select("*", *_rates(g)), "hunter-ranking"), [], [F.desc("store_sin_fl"), F.col("hunter_").asc()], "rank")
    return g.withColumn("rank", F.col("rank") + 1).orderBy("rank")


def quality_by_dim(silver: DataFrame, dims: tuple[str, ...] = ("hunter_", "coordinador", "channel")) -> DataFrame:
    """The same counts and rates at each single-dimension grain, in one
    GROUPING SETS aggregation: (dim, value, metrics...)."""
    f = _flags(silver)
    g = f.groupingSets([[d] for d in dims], *dims).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in COUNTS], F.grouping_id().alias("gid"))
    n = len(dims)
    dim_name = None
    for i, d in enumerate(dims):
        gid = (1 << n) - 1 - (1 << (n - 1 - i))  # only dim i grouped
        dim_name = (F.when(F.col("gid") == gid, F.lit(d)) if dim_name is None
                    else dim_name.when(F.col("gid") == gid, F.lit(d)))
    value = F.coalesce(*[F.col(d) for d in dims])
    out = g.select(dim_name.alias("dim"), value.alias("value"), *COUNTS)
    return out.select("*", *_rates(out))


def _entity_long(silver: DataFrame) -> DataFrame:
    stacked = F.explode(F.array(*[F.struct(F.lit(e).alias("entity_type"), F.col(e).alias("entity"))
                                  for e in ENTITIES])).alias("e")
    return silver.select("hunter_", "store_id", "first_login", stacked).select(
        "hunter_", "store_id", "first_login", "e.entity_type", "e.entity")


def _entity_counts(silver: DataFrame) -> DataFrame:
    """Stores and stores without login per rep, entity type and entity."""
    return _entity_long(silver).groupBy("hunter_", "entity_type", "entity").agg(
        F.count(F.lit(1)).alias("total_store_wo"),
        F.sum(F.when(F.col("first_login").isNull(), F.lit(1)).otherwise(F.lit(0))).cast("bigint")
        .alias("store_sin_login_wo"))


def _worst_key():
    """Least first: most stores without login, then most stores, then the name."""
    return F.struct((-F.col("store_sin_login_wo")).alias("neg_sin"), (-F.col("total_store_wo")).alias("neg_tot"), F.col("entity"))


def worst_offender(silver: DataFrame) -> DataFrame:
    """Per rep and entity type (legal name, brand, address): the entity with
    most stores without login; ties -> more stores, then name ascending."""
    best = _entity_counts(silver).groupBy("hunter_", "entity_type").agg(F.min(_worst_key()).alias("b"))
    return best.select("hunter_", "entity_type", F.col("b.entity").alias("entity"),
                       (-F.col("b.neg_tot")).alias("total_store_wo"),
                       (-F.col("b.neg_sin")).alias("store_sin_login_wo"))


def offender_stores(silver: DataFrame, offenders: DataFrame) -> DataFrame:
    """The stores behind each worst offender: every store carries its columns
    through the unpivot, so SILVER meets the offenders in one join."""
    kept = ["store_id", "fecha_envio_de_credenciales", "first_login", "handoff", "orders_0_28"]
    stacked = F.explode(F.array(*[F.struct(F.lit(e).alias("entity_type"), F.col(e).alias("entity")) for e in ENTITIES])).alias("e")
    long = silver.select("hunter_", *kept, stacked).select("hunter_", *kept, "e.entity_type", "e.entity")
    return long.join(offenders.select("hunter_", "entity_type", "entity"), ["hunter_", "entity_type", "entity"], "left_semi")


def gold_table(silver: DataFrame, as_of: str) -> DataFrame:
    """The GOLD row of every rep: counts, the ready-made rate of stores without
    login, the churn rate of the month before ``as_of`` (churnm1: over the
    stores that first logged in then) and, per entity type, the worst offender
    with its stores and its stores without login.

    The offenders are minima of structs, all types in one aggregation, so
    they arrive wide; a rep of any size is combined before the shuffle."""
    month = F.trunc(F.lit(as_of).cast("date"), "month")
    last = (F.col("first_login") >= F.add_months(month, -1)) & (F.col("first_login") < month)
    g = _flags(silver).groupBy("hunter_").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in COUNTS],
        F.sum(F.when(last, F.col("churn"))).alias("m1"), F.sum(F.when(last, F.col("total_store_churn"))).alias("m1_all"))
    wide = _entity_counts(silver).groupBy("hunter_").agg(*[F.min(F.when(F.col("entity_type") == e, _worst_key())).alias(e) for e in ENTITIES])
    j = g.join(wide.withColumnRenamed("hunter_", "_h"), F.col("hunter_").eqNullSafe(F.col("_h")))
    offenders = [c for e in ENTITIES for c in (F.col(f"{e}.entity").alias(f"{e}_wo"), (-F.col(f"{e}.neg_tot")).alias(f"total_store_{e}_wo"),
                                               (-F.col(f"{e}.neg_sin")).alias(f"store_sin_login_{e}_wo"))]
    return j.select("hunter_", *COUNTS, round_half_away(safe_div("store_sin_fl", "total_store"), 6).alias("store_sin_login_rate"),
                    round_half_away(safe_div("m1", "m1_all"), 6).alias("churnm1"), *offenders)


def gold_check(stored_gold: DataFrame, derived_gold: DataFrame, key: str = "hunter_") -> DataFrame:
    """Every value of a stored GOLD table against the derived one: (key, field,
    stored, derived, ok) as text, equal NULLs agreeing. A rep that only one
    side has is reported too, with the field of the key itself not ok."""
    fields = [c for c in derived_gold.columns if c != key]
    told = lambda df, c: (df[c].cast("decimal(18,6)") if dict(df.dtypes)[c] == "double" else df[c]).cast("string")

    def side(df, name):
        return df.select(F.col(key), F.struct(F.lit("yes").alias(key), *[told(df, c).alias(c) for c in fields]).alias(name))
    s, d = side(stored_gold, "stored").withColumnRenamed(key, "_k"), side(derived_gold, "derived")
    j = s.join(d, F.col("_k").eqNullSafe(F.col(key)), "full_outer")
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"stored.{c}").alias("stored"), F.col(f"derived.{c}").alias("derived"))
                                for c in [key, *fields]])).alias("p")
    out = j.select(F.coalesce(key, "_k").alias(key), pairs).select(key, "p.*")
    return out.withColumn("ok", F.col("stored").eqNullSafe(F.col("derived")))


def low_availability(silver: DataFrame, threshold: float = 0.2) -> DataFrame:
    """Stores whose availability is under ``threshold`` in any window."""
    wins = ["av_0_28", "av_last_week", "av_last_2week", "av_l4w"]
    flags = [(F.col(w) < threshold).alias(f"low_{w[3:]}") for w in wins]
    any_low = F.greatest(*[F.col(w) < threshold for w in wins])
    return silver.where(any_low).select("store_id", "hunter_", "coordinador", "channel", *wins, *flags)


def partner_cancellations(silver: DataFrame, min_cancels: int = 3) -> DataFrame:
    """Per rep: stores with at least ``min_cancels`` partner-attributed
    cancellations in 0-28 days, their cancellations and share of stores."""
    hi = F.col("orders_cancel_partner_0_28") >= min_cancels
    g = silver.groupBy("hunter_").agg(
        F.count(F.lit(1)).alias("total_store"),
        F.sum(F.when(hi, F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias("stores_high_cancel"),
        F.sum(F.when(hi, F.col("orders_cancel_partner_0_28")).otherwise(F.lit(0))).cast("bigint")
        .alias("cancels_high"),
        F.sum("orders_cancel_partner_0_28").cast("bigint").alias("cancels_total"))
    return g.withColumn("share_high_cancel", safe_div("stores_high_cancel", "total_store"))


def no_login_stores(silver: DataFrame) -> DataFrame:
    """Stores whose credentials were sent but that never logged in."""
    return (silver.where(F.col("fecha_envio_de_credenciales").isNotNull() & F.col("first_login").isNull())
            .select("store_id", "hunter_", "coordinador", "channel", "razon_social", "brand_name", "adress",
                    "fecha_envio_de_credenciales"))
