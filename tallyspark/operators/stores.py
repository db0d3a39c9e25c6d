"""Store-level detail: history of given stores, latest state per store,
and the column catalogue of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.operators.calendar import snapshot_day


def store_history(history: DataFrame, stores: DataFrame, id_col: str = "external_store_id",
                  stores_id_col: str = "store_id") -> DataFrame:
    """Rows of the given stores (semi join with a DataFrame of ids, so the
    id list is never shipped through the driver)."""
    ids = stores.select(F.col(stores_id_col).alias(id_col)).distinct()
    return history.join(ids, id_col, "left_semi")


#: A day takes its place above any 64-bit tie key, a second above it too.
_TIE, _SECONDS = 10**19, 10**11


def _wide(x):
    """A whole number, constant or column, as a decimal of the widest kind."""
    return (F.lit(str(x)) if isinstance(x, int) else x).cast("decimal(38,0)")


def _packed(day, tie, seconds=None):
    """Day, then seconds, then tie key as one decimal in their order. A decimal
    has a fixed width, so its maximum is a hash aggregate without a sort.
    NULLs come before every value."""
    out = F.coalesce(_wide(F.unix_date(day)), _wide(-(10**6)))
    if seconds is not None:
        out = _wide(out * _wide(_SECONDS)) + F.coalesce(_wide(seconds), _wide(-(10**10)))
    return _wide(_wide(_wide(out) * _wide(_TIE)) + F.coalesce(_wide(F.col(tie)), _wide(-(2**62))))


def store_latest(history: DataFrame, id_col: str = "external_store_id", day_col: str = "day_date",
                 tie_col: str = "order_id") -> DataFrame:
    """Current state per store: the row with the latest day (ties -> larger
    ``tie_col``, which tells the rows of a store and day apart).

    Late materialization: a hash aggregate finds each store's greatest (day,
    tie key), one decimal, and a semi join brings its row. No row is
    carried through the aggregate, and the join's key spreads the rows of a
    store with a huge history."""
    h = history.withColumn("_place", _packed(F.col(day_col), tie_col))
    top = h.groupBy(id_col).agg(F.max("_place").alias("_place"))
    same = h[id_col].eqNullSafe(top[id_col]) & (h["_place"] == top["_place"])
    return h.join(top, same, "left_semi").drop("_place")


def snapshots_as_of(history: DataFrame, refreshes: list[str], id_col: str, day_col: str, loaded_col: str, tie_col: str,
                    cutoff: str = "08:15", tz: str = "America/Bogota") -> DataFrame:
    """The snapshot of every key that a refresh shows: (refresh_day, the
    columns of ``history``, age_days), for every refresh from the first that
    shows the key.

    A refresh runs at ``cutoff`` local time of its day and shows what was loaded
    before. Of these the latest snapshot day counts; of repeated loads of that
    day the last one (by second, then ``tie_col``). So a late snapshot of an
    older day never replaces a newer one, while a later load of the same
    day corrects it from the next refresh on.

    ``refreshes`` (days as text) is a parameter, not data. A hash aggregate
    keeps the greatest place per key and business day of the load; these days
    go to the first refresh that shows them, a running maximum over a key's
    few refreshes carries the place on, and a join by key and place brings the rows."""
    days = sorted(set(refreshes))
    listed = F.array(*[F.lit(x).cast("date") for x in days])
    place = _packed(F.col(day_col), tie_col, F.unix_timestamp(F.col(loaded_col).cast("timestamp")))
    h = history.where(F.col(day_col).isNotNull() & F.col(loaded_col).isNotNull()).withColumn("_place", place)
    # Loaded in the business day D: the refresh that ends D runs on D + 1.
    shown = snapshot_day(h, loaded_col, cutoff, tz, "_seen").withColumn("_shown", F.date_add("_seen", 1))
    daily = shown.where(F.col("_shown") <= F.lit(days[-1]).cast("date")).groupBy(id_col, "_shown").agg(F.max("_place").alias("_best"))
    best = daily.withColumn("_first", F.size(F.filter(listed, lambda r: r < F.col("_shown")))).groupBy(id_col, "_first").agg(F.max("_best").alias("_best"))
    w = W.partitionBy(id_col).orderBy("_first")
    best = best.select(id_col, "_first", F.max("_best").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("_best"),
                       F.coalesce(F.lead("_first").over(w), F.lit(len(days))).alias("_next"))
    best = best.select(id_col, "_best", F.explode(F.sequence("_first", F.col("_next") - 1)).alias("_r"))
    j = h.alias("h").join(best.alias("b"), F.expr(f"h.`{id_col}` <=> b.`{id_col}` AND h._place = b._best"))
    day = F.element_at(listed, F.col("_r") + 1)
    return j.select(day.alias("refresh_day"), *[F.col(f"h.`{c}`").alias(c) for c in history.columns],
                    F.date_diff(day, F.col(f"h.`{day_col}`")).alias("age_days"))


def describe_columns(df: DataFrame) -> DataFrame:
    """Column catalogue of a table: ordinal, name, type, nullable, comment
    (from the schema metadata). Metadata only: its size is the number of
    columns, independent of the data."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable, f.metadata.get("comment"))
            for i, f in enumerate(df.schema.fields)]
    schema = T.StructType([T.StructField("ordinal_position", T.IntegerType()),
                           T.StructField("column_name", T.StringType()),
                           T.StructField("data_type", T.StringType()),
                           T.StructField("is_nullable", T.BooleanType()),
                           T.StructField("comment", T.StringType())])
    return df.sparkSession.createDataFrame(rows, schema)
