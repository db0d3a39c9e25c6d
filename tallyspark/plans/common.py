"""Small helpers shared by the query modules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tallyspark.functions.exprs import round_half_away

# Parameters of the registered queries (fixed so Spark and the oracle agree).
AS_OF = "2001-07-18 03:00:00"   # UTC "now" for closed-week cuts
TZ = "America/Bogota"


def round_doubles(df: DataFrame, n: int = 6, skip: tuple[str, ...] = ()) -> DataFrame:
    """Round every double column half-away-from-zero to ``n`` decimals.
    Sums of non-dyadic doubles depend on the order of addition; rounding
    the final values makes results stable across engines and partitions."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)) and f.name not in skip:
            cols.append(round_half_away(F.col(f"`{f.name}`"), n).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)
