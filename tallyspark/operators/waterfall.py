"""Waterfall bars and closure checks for any bridge.

A bridge in long form is (bridge, q, seq, label, kind, delta) with one
``base`` row, the ``effect`` rows and one ``total`` row. Bars float from
the running total: a windowed running sum partitioned by (bridge, q), so
each window holds only the handful of bars of one bridge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from tallyspark.functions.exprs import round_half_away, safe_div
from tallyspark.operators.bridge import bridge_is_report

# Fixed: effect labels in order, and the closure tolerance (stores).
HT_EFFECTS = [("ef_prod", "Productividad"), ("ef_madurez", "Madurez"), ("ef_hc", "Headcount"),
              ("ef_ausencias", "Ausencias"), ("ef_sin_target", "Sin target")]
SHAPLEY_EFFECTS = [("ef_productivity", "Productividad"), ("ef_capacity", "Capacidad"), ("ef_maturity", "Madurez")]
CLOSURE_TOLERANCE = 1.0


def _row(seq, label, kind, value):
    return F.struct(F.lit(seq).alias("seq"), F.lit(label).alias("label"), F.lit(kind).alias("kind"),
                    value.cast("double").alias("delta"))


def is_bridge_long(effects: DataFrame) -> DataFrame:
    """IS bridge (``bridge_is_effects``) -> long bars per quarter: every
    project of the data has its effects, rounded to a tenth."""
    r1 = lambda c: round_half_away(c, 1)
    ends = effects.groupBy("q").agg(F.sum("stores_tg").alias("base"), F.sum("stores_real").alias("total"))
    ends = ends.select("q", F.explode(F.array(_row(0, "Target", "base", r1(F.col("base"))), _row(1_000_000, "Real", "total", r1(F.col("total"))))).alias("r")).select("q", "r.*")
    bars = bridge_is_report(effects).select("q", "seq", "label", F.lit("effect").alias("kind"), F.col("delta").cast("double").alias("delta"))
    all_ = ends.unionByName(bars)
    # The total follows the last effect of its quarter.
    order = F.row_number().over(W.partitionBy("q").orderBy("seq")) - 1
    return all_.select(F.lit("IS").alias("bridge"), "q", order.cast("int").alias("seq"), "label", "kind", "delta")


def _bars(wide: DataFrame, bridge: str, base: str, effects: list, total: str) -> DataFrame:
    rows = [_row(0, "Target", "base", F.col(base))]
    rows += [_row(i, name, "effect", F.col(c)) for i, (c, name) in enumerate(effects, start=1)]
    rows.append(_row(len(effects) + 1, "Real", "total", F.col(total)))
    return wide.select("q", F.explode(F.array(*rows)).alias("r")).select(F.lit(bridge).alias("bridge"), "q", "r.*")


def ht_bridge_long(bridge_ht: DataFrame) -> DataFrame:
    """HT bridge -> long bars. The base is the reconstructed target S0 (the
    only base the effects close against), the total every real store."""
    return _bars(bridge_ht, "HT", "target_reconstruido", HT_EFFECTS, "actual_total")


def shapley_long(shapley: DataFrame, bridge: str) -> DataFrame:
    """A Shapley bridge, summed to quarters and rounded to a thousandth -> long bars."""
    names = ["target_total", *[c for c, _ in SHAPLEY_EFFECTS], "real_total"]
    wide = shapley.groupBy("q").agg(*[round_half_away(F.sum(c), 3).alias(c) for c in names])
    return _bars(wide, bridge, "target_total", SHAPLEY_EFFECTS, "real_total")


def waterfall_bars(long: DataFrame) -> DataFrame:
    """Start/end of every bar: base and total start at 0, each effect floats
    from the running total of the bars before it."""
    w = W.partitionBy("bridge", "q").orderBy("seq").rowsBetween(W.unboundedPreceding, W.currentRow)
    run = F.sum(F.when(F.col("kind") != "total", F.col("delta")).otherwise(F.lit(0.0))).over(w)
    base = F.max(F.when(F.col("kind") == "base", F.col("delta"))).over(W.partitionBy("bridge", "q"))
    end = F.when(F.col("kind") == "total", F.col("delta")).otherwise(run)
    start = F.when(F.col("kind") == "effect", run - F.col("delta")).otherwise(F.lit(0.0))
    return long.select("bridge", "q", "seq", "label", "kind", "delta", start.alias("start"), end.alias("end"),
                       round_half_away(safe_div(F.col("delta"), base) * 100, 1).alias("pct_of_base"))


def bridge_closure(long: DataFrame, actual: DataFrame | None = None,
                   tolerance: float = CLOSURE_TOLERANCE) -> DataFrame:
    """base + sum(effects) - actual per bridge and quarter. ``actual``
    (bridge, q, actual) replaces the bridge's own total with an independent
    one (for HT the worlds telescope, so only an outside total tests them)."""
    s = long.groupBy("bridge", "q").agg(
        F.sum(F.when(F.col("kind") == "base", F.col("delta"))).alias("base"),
        F.sum(F.when(F.col("kind") == "effect", F.col("delta"))).alias("effects"),
        F.sum(F.when(F.col("kind") == "total", F.col("delta"))).alias("actual"))
    if actual is not None:
        s = s.drop("actual").join(actual, ["bridge", "q"], "left")
    # A quarter without any target has no base: its effects alone must reach the actual.
    diff = round_half_away(F.coalesce("base", F.lit(0.0)) + F.coalesce("effects", F.lit(0.0)) - F.col("actual"), 6)
    return s.select("bridge", "q", "base", "effects", "actual", diff.alias("diff"),
                    (F.abs(diff) <= tolerance).alias("ok"))


def _effects_array(long: DataFrame) -> DataFrame:
    return long.where(F.col("kind") == "effect").groupBy("bridge", "q").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("seq", "label", "delta"))),
                    lambda x: F.struct(x["label"].alias("label"), x["delta"].alias("delta"))).alias("efectos"))


def _weeks_array(weeks: DataFrame) -> DataFrame:
    return weeks.groupBy("q").agg(F.array_sort(F.collect_set(F.date_format("week", "yyyy-MM-dd"))).alias("semanas"))


def bridge_json(long: DataFrame, weeks: DataFrame, mode: str) -> DataFrame:
    """IS payload per (bridge, q): mode, weeks used, target, real, gap,
    gap %, and the ordered effects. Arrays hold one entry per bar or per
    week of a quarter, so they are bounded by the calendar."""
    tot = long.groupBy("bridge", "q").agg(
        F.sum(F.when(F.col("kind") == "base", F.col("delta"))).alias("target_total"),
        F.sum(F.when(F.col("kind") == "total", F.col("delta"))).alias("real_total"))
    j = tot.join(_effects_array(long), ["bridge", "q"], "left").join(_weeks_array(weeks), "q", "left")
    gap = F.col("real_total") - F.col("target_total")
    payload = F.struct(F.lit(mode).alias("modalidad"), "semanas", "target_total", "real_total",
                       round_half_away(gap, 1).alias("desvio"),
                       round_half_away(safe_div(gap, F.col("target_total")) * 100, 1).alias("desvio_pct"),
                       "efectos")
    return j.select("bridge", "q", F.to_json(payload).alias("json"))


def bridge_ht_json(bridge_ht: DataFrame, weeks: DataFrame, mode: str) -> DataFrame:
    """HT payload per q: the official and the reconstructed target apart,
    the gap of the real stores of the target universe against the official
    target, all real stores, and the ordered effects."""
    e = _effects_array(ht_bridge_long(bridge_ht)).drop("bridge")
    j = bridge_ht.join(e, "q", "left").join(_weeks_array(weeks), "q", "left")
    payload = F.struct(F.lit(mode).alias("modalidad"), "semanas", "target_oficial", "target_reconstruido",
                       F.col("actual").alias("real_total"), F.col("actual_total").alias("real_con_sin_target"),
                       F.col("desvio_vs_tg_oficial").alias("desvio"), "desvio_pct", "efectos")
    return j.select(F.lit("HT").alias("bridge"), "q", F.to_json(payload).alias("json"))
