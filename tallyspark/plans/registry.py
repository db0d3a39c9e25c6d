"""Query registry: one callable per query key, ``(spark, sf_dir) -> DataFrame``.

Every query reads the given tables through the adapter and runs over all
quarters (``q`` is a key), so its work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a Spark query under ``name`` with its oracle SQL."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    # Importing the modules registers their queries.
    from tallyspark.plans import (q_bridge, q_calendar, q_churn, q_deepdive, q_kpi,  # noqa: F401
                                  q_quality, q_report, q_targets)
