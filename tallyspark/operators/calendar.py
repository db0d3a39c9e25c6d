"""Calendar and temporal alignment (week axis, weeks with actuals, closed
weeks, business snapshot day, alignment report).

The quarter label ``q`` is an explicit column that is never derived from
dates inside an operator. ``quarter=None`` runs every quarter at once with
``q`` as a key; a quarter string filters first (pushed to the scan).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_quarter(df: DataFrame, quarter: str | None, col: str = "q") -> DataFrame:
    return df if quarter is None else df.where(F.col(col) == quarter)


def week_axis(target: DataFrame, quarter: str | None = None, week_col: str = "week") -> DataFrame:
    """Declared week axis of each quarter, taken from the targets (it
    includes future weeks that have no actuals yet)."""
    return in_quarter(target, quarter).select("q", F.col(week_col).alias("week")).distinct()


def weeks_available(funnel: DataFrame, quarter: str | None = None,
                    week_col: str = "week_date") -> DataFrame:
    """Weeks with actuals loaded, per quarter."""
    return in_quarter(funnel, quarter).select("q", F.col(week_col).alias("week")).distinct()


def last_week(funnel: DataFrame, quarter: str | None = None, week_col: str = "week_date") -> DataFrame:
    """Last week with actuals, per quarter."""
    return in_quarter(funnel, quarter).groupBy("q").agg(F.max(week_col).alias("last_week"))


def valid_weeks(funnel: DataFrame, mode: str = "QTD", quarter: str | None = None,
                week_col: str = "week_date", by: tuple[str, ...] = (),
                exclude: DataFrame | None = None) -> DataFrame:
    """(q, week[, by...]) the comparison may use.

    QTD: every week with actuals; LW: only the last week of the quarter.
    ``by`` narrows validity to a finer grain (HT uses week x country);
    ``exclude`` (week) takes weeks out before the last one is chosen.
    """
    f = in_quarter(funnel, quarter)
    if exclude is not None:
        f = f.join(exclude.select(F.col("week").alias(week_col)).distinct(), week_col, "left_anti")
    weeks = f.select("q", F.col(week_col).alias("week"), *by).distinct()
    if mode == "QTD":
        return weeks
    if mode != "LW":
        raise ValueError(f"mode must be QTD or LW, got {mode!r}")
    lw = last_week(f, week_col=week_col).withColumnRenamed("last_week", "week")
    return weeks.join(lw, ["q", "week"], "left_semi")


def align_weeks(target: DataFrame, funnel: DataFrame, mode: str = "QTD", quarter: str | None = None,
                exclude: DataFrame | None = None, target_week: str = "week",
                funnel_week: str = "week_date", by: tuple[str, ...] = ()) -> DataFrame:
    """Target rows restricted to the weeks with actuals (semi join), minus
    user-excluded weeks, which are dropped from both sides (anti join)."""
    weeks = valid_weeks(funnel, mode, quarter, funnel_week, by, exclude)
    t = in_quarter(target, quarter)
    cond = [t["q"] == weeks["q"], t[target_week] == weeks["week"]] + [t[b] == weeks[b] for b in by]
    return t.join(weeks, cond, "left_semi")


def closed_weeks(weeks: DataFrame, as_of: str, tz: str = "America/Bogota",
                 week_col: str = "week") -> DataFrame:
    """Weeks that are closed at ``as_of`` (a UTC timestamp string): strictly
    before the Monday of the current week in zone ``tz``."""
    cur = F.to_date(F.date_trunc("week", F.from_utc_timestamp(F.lit(as_of).cast("timestamp"), tz)))
    return weeks.where(F.col(week_col) < cur)


def snapshot_day(df: DataFrame, ts_col: str, cutoff: str = "08:15",
                 tz: str = "America/Bogota", out: str = "snapshot_day") -> DataFrame:
    """Business snapshot date of each row: data refreshed daily at
    ``cutoff`` local time belongs to the previous day until the refresh."""
    hh, mm = (int(x) for x in cutoff.split(":"))
    local = F.from_utc_timestamp(F.col(ts_col).cast("timestamp"), tz)
    shifted = local - F.make_dt_interval(F.lit(0), F.lit(hh), F.lit(mm), F.lit(0))
    return df.withColumn(out, F.to_date(shifted))


def alignment_report(funnel: DataFrame, target_used: DataFrame, quarter: str | None = None,
                     funnel_week: str = "week_date", target_week: str = "week") -> DataFrame:
    """Per quarter: min/max/count of real weeks, count of target weeks used,
    and ok = target weeks used <= real weeks."""
    r = (in_quarter(funnel, quarter).groupBy("q")
         .agg(F.min(funnel_week).alias("min_week_real"), F.max(funnel_week).alias("max_week_real"),
              F.countDistinct(funnel_week).alias("n_weeks_real")))
    t = (in_quarter(target_used, quarter).groupBy("q")
         .agg(F.countDistinct(target_week).alias("n_weeks_target_used")))
    return (r.join(t, "q", "full_outer")
            .select("q", "min_week_real", "max_week_real",
                    F.coalesce("n_weeks_real", F.lit(0)).alias("n_weeks_real"),
                    F.coalesce("n_weeks_target_used", F.lit(0)).alias("n_weeks_target_used"))
            .withColumn("ok", F.col("n_weeks_target_used") <= F.col("n_weeks_real")))


def alignment_of(tables: dict[str, tuple[DataFrame, DataFrame, str, str]]) -> DataFrame:
    """``alignment_report`` of every fact with its targets, in one result with
    the fact's name as ``source``; ``tables``: name -> (funnel, target rows
    used, week column of the funnel, of the target)."""
    parts = [alignment_report(f, t, funnel_week=fw, target_week=tw).select(F.lit(name).alias("source"), "*") for name, (f, t, fw, tw) in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
