"""Scans of the input tables.

Only ``spark.read.parquet`` is used: column pruning and predicate pushdown
reach the Parquet reader because every operator selects its columns early.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_TABLES = ("region nation customer supplier part orders lineitem events documents "
              "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
