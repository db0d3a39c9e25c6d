"""Column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen. Three different division guards exist on purpose (they are not
interchangeable):

* ``safe_div``     a / NULLIF(b, 0)                    -> NULL when b is 0
* ``guarded_div``  CASE WHEN b > 0 THEN a / b ELSE 0   -> 0 when b <= 0
* ``null_div``     CASE WHEN b > 0 THEN a / b          -> NULL when b <= 0
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the business rules (do not edit).
# Aging categories of the rep funnel and their target labels.
AGING_LABELS = {
    "New Entry": "01 - new entry",
    "Junior": "02 - junior",
    "Senior": "03 - senior",
}
# Senior is the "old" category used by the % old headcount metrics.
SENIOR = "Senior"
# Early-churn channel mapping (upper-cased source value -> channel code),
# and the display order of the churn channels.
CHURN_CHANNELS = {
    "HUNTING": "HUNTING",
    "INSIDE SALES": "IS",
    "BRAND EXPANSION": "BE",
    "SELF-ONBOARDING": "SOB",
}
CHANNEL_ORDER = ["HUNTING", "IS", "SOB", "BE", "TOTAL"]
# Performance buckets of the deep dives, in display order.
IS_BUCKETS = [
    "00 stores",
    "<50% target prod",
    "50-80% target prod",
    "80-100% target prod",
    ">= target prod",
]
HT_BUCKETS = ["00 stores", "<50% target prod", "50-80% target prod", ">= target prod"]
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(num, den) -> Column:
    """``num / NULLIF(den, 0)``: NULL for a zero or NULL denominator."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


def guarded_div(num, den, default: float = 0.0) -> Column:
    """``CASE WHEN den > 0 THEN num / den ELSE default END``."""
    den = _c(den)
    return F.when(den > 0, _c(num) / F.nullif(den, F.lit(0))).otherwise(F.lit(default))


def null_div(num, den) -> Column:
    """``CASE WHEN den > 0 THEN num / den END`` (NULL otherwise)."""
    den = _c(den)
    return F.when(den > 0, _c(num) / F.nullif(den, F.lit(0)))


def round_half_away(x, n: int) -> Column:
    """Round half away from zero to ``n`` decimals.

    Engines disagree on ``round`` of doubles such as 1.005, and sums of the
    same terms added in a different order differ in the last bits, which
    flips values sitting exactly on a tie (frequent with small rational
    inputs). So the value is first snapped to 9 decimals, then rounded with
    plain arithmetic in doubles, one rule for every size (a remainder takes
    the fraction off, so no integer type limits the range). ``+ 0.0`` turns
    a negative zero into zero.
    """
    x = F.round(_c(x).cast("double"), 9)
    scale = float(10**n)
    up = F.abs(x) * F.lit(scale) + F.lit(0.5)
    return F.signum(x) * (up - up % F.lit(1.0)) / F.lit(scale) + F.lit(0.0)


def week_start(ts) -> Column:
    """Monday of the week of a timestamp/date, as a date."""
    return F.to_date(F.date_trunc("week", _c(ts)))


def quarter_label(week) -> Column:
    """Explicit quarter label ``YYYY-Qn`` of a week's Monday."""
    week = _c(week)
    return F.concat(F.year(week).cast("string"), F.lit("-Q"), F.quarter(week).cast("string"))


def norm_key(x) -> Column:
    """``UPPER(TRIM(x))``: the normalized form used for every aging join key."""
    return F.upper(F.trim(_c(x)))


def aging_label(category) -> Column:
    """Aging category -> target label (searched CASE, unmapped -> NULL)."""
    category = _c(category)
    expr = None
    for cat, label in AGING_LABELS.items():
        expr = (F.when(category == cat, F.lit(label)) if expr is None
                else expr.when(category == cat, F.lit(label)))
    return expr


def aging_key(category) -> Column:
    """Normalized join key of a funnel aging category (NULL if unmapped)."""
    return norm_key(aging_label(category))


def churn_channel(channel_am) -> Column:
    """Upper-cased channel name -> churn channel code; unmapped -> NULL."""
    up = F.upper(_c(channel_am))
    expr = None
    for src, code in CHURN_CHANNELS.items():
        expr = F.when(up == src, F.lit(code)) if expr is None else expr.when(up == src, F.lit(code))
    return expr


def channel_rank(channel) -> Column:
    channel = _c(channel)
    expr = None
    for i, ch in enumerate(CHANNEL_ORDER, start=1):
        expr = F.when(channel == ch, F.lit(i)) if expr is None else expr.when(channel == ch, F.lit(i))
    return expr


def perf_bucket(stores, dias, prod_target, levels: str = "IS") -> Column:
    """Ordinal performance bucket of a rep (first match wins).

    With no target (NULL/0) a rep with stores falls into ">= target prod",
    exactly as the business rule states. HT has four labels; its
    "50-80%" label covers 50-100 % of target.
    """
    stores, dias, pt = _c(stores), _c(dias), _c(prod_target)
    has_tg = F.coalesce(pt, F.lit(0.0)) > 0
    prod = safe_div(stores, dias)
    b = F.when(stores == 0, F.lit(IS_BUCKETS[0])).when(has_tg & (prod < 0.5 * pt), F.lit(IS_BUCKETS[1]))
    if levels == "IS":
        b = b.when(has_tg & (prod < 0.8 * pt), F.lit(IS_BUCKETS[2])).when(
            has_tg & (prod < pt), F.lit(IS_BUCKETS[3]))
    else:
        b = b.when(has_tg & (prod < pt), F.lit(HT_BUCKETS[2]))
    return b.otherwise(F.lit(IS_BUCKETS[4]))


def bucket_rank(bucket, levels: str = "IS") -> Column:
    bucket = _c(bucket)
    names = IS_BUCKETS if levels == "IS" else HT_BUCKETS
    expr = None
    for i, name in enumerate(names[:-1], start=1):
        expr = F.when(bucket == name, F.lit(i)) if expr is None else expr.when(bucket == name, F.lit(i))
    return expr.otherwise(F.lit(len(names)))
