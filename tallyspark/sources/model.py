"""Model tables as materialized datasets.

The business queries run over GOLD/SILVER warehouse tables. Here those
tables are derived from the raw test tables by ``testdata``; this module
writes each derived table once per Spark application, as Parquet, in the
shared folder named by ``spark.checkpoint.dir`` and serves later reads of
that application from there, like a warehouse table. Tables with a quarter
are partitioned by it (the rep funnels by week too), so a filter or a join on
few quarters or weeks reads only their folders, and sorted by week inside
each file.

Nothing is served across applications, so neither code nor input of an
earlier run can answer a query. Within one, a table is built again when its
input changes: the size, number of files (folders below included) and
modification time of every raw table are compared, one call each, without
listing files on the driver.

Set ``TALLYSPARK_MATERIALIZE=0`` to compute every table lazily instead.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyspark.session import ensure_checkpoint_dir
from tallyspark.sources import testdata
from tallyspark.sources.tables import RAW_TABLES

# Sort keys of each model table (quarter first where the table has one).
SORT_KEYS = {
    "is_funnel": ["q", "week_date"], "ht_funnel": ["q", "week_date"],
    "is_target": ["q", "week"], "ht_target": ["q", "week"],
    "elc_funnel": ["q", "week"], "elc_target": ["q", "week"],
    "churn_detail": ["week"], "churn_target": ["week"],
    "store_detail": ["store_id"], "store_history": ["external_store_id"], "store_snapshot": ["store_id"],
}

# Folders of the tables that are read a week at a time: the last week of a quarter is found from folder names and read alone.
FOLDERS = {"is_funnel": ["q", "week_date"], "ht_funnel": ["q", "week_date"]}

# (application, input folder, table) -> (input version, folder of the stored table)
_STORED: dict[tuple[str, str, str], tuple[tuple, str]] = {}


def input_version(spark: SparkSession, sf_dir: str) -> tuple:
    """Size, file count, folder count and modification time of every raw table."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for t in RAW_TABLES:
        p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            s = fs.getContentSummary(p)
            out.append((t, s.getLength(), s.getFileCount(), s.getDirectoryCount(), fs.getFileStatus(p).getModificationTime()))
    return tuple(out)


# Aggregates of a raw table that several model tables start from: stored once, handed to their builders as ``weeks``.
SHARED = {"is_funnel": "supplier_week", "ht_funnel": "supplier_week", "elc_target": "supplier_week",
          "is_target": "order_nation_weeks", "ht_target": "order_nation_weeks"}


def _store(spark: SparkSession, sf_dir: str, name: str, build, sort_keys: list[str], ready: bool = False) -> DataFrame:
    """``ready``: the rows come dealt by their folders and sorted."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    version = input_version(spark, sf_dir)
    if key not in _STORED or _STORED[key][0] != version:
        df = build()
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tallyspark-model/{name}-{uuid.uuid4().hex}"
        if sort_keys and sort_keys[0] == "q":
            # Balanced by size, so neither a large quarter nor many small ones decide the files.
            folders = FOLDERS.get(name, ["q"])
            rows = df if ready else df.hint("rebalance", *folders).sortWithinPartitions(*sort_keys)
            rows.write.partitionBy(*folders).parquet(path)
        else:
            (df.sortWithinPartitions(*sort_keys) if sort_keys else df).write.parquet(path)
        _STORED[key] = (version, path)
        _SCHEMAS[path] = df.schema
    path = _STORED[key][1]
    schema = _SCHEMAS[path]
    return spark.read.schema(schema).parquet(path).select(*schema.names)


_SCHEMAS: dict = {}


def materialized(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    build = getattr(testdata, name)
    if os.environ.get("TALLYSPARK_MATERIALIZE", "1") == "0":
        return build(spark, sf_dir)
    more = {}
    if name in SHARED:
        start = getattr(testdata, SHARED[name])
        more["weeks"] = derived(spark, sf_dir, SHARED[name], lambda: start(spark, sf_dir))
    if name in FOLDERS:
        more["balanced"] = True
    return _store(spark, sf_dir, name, lambda: build(spark, sf_dir, **more), SORT_KEYS[name], ready=name in FOLDERS)


def derived(spark: SparkSession, sf_dir: str, name: str, build, sort_keys: tuple[str, ...] = ()) -> DataFrame:
    """An intermediate table that several queries of one application share."""
    if os.environ.get("TALLYSPARK_MATERIALIZE", "1") == "0":
        return build()
    return _store(spark, sf_dir, name, build, list(sort_keys))


def _reader(name: str):
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        return materialized(spark, sf_dir, name)
    read.__name__ = name
    read.__doc__ = f"Materialized model table ``{name}`` (see ``testdata.{name}``)."
    return read


is_funnel = _reader("is_funnel")
ht_funnel = _reader("ht_funnel")
is_target = _reader("is_target")
ht_target = _reader("ht_target")
elc_funnel = _reader("elc_funnel")
elc_target = _reader("elc_target")
churn_detail = _reader("churn_detail")
churn_target = _reader("churn_target")
store_detail = _reader("store_detail")
store_history = _reader("store_history")
store_snapshot = _reader("store_snapshot")
MODEL_TABLES = list(SORT_KEYS)
