"""The corpus queries in a session that starts outside the repository."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
RUN = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.checkpoint.dir", sys.argv[2]).config("spark.driver.memory", "2g").getOrCreate())
import __spark_entry__ as E
q, d = E.queries(), "/root/testdata/sf0.001"
for k in ("op2_secret_scan", "op13_source_mix", "op9_quality_classifier", "op12_fill_in_middle"):
    print(k, q[k](spark, d).count())
print("weeks_available", q["weeks_available"](spark, d).count() > 0)
print("range", spark.range(10).count())
print("distinct", spark.range(10).rdd.map(lambda x: __import__("tallyspark.llm.common").llm.common.CHUNK_BYTES).distinct().count())
"""


def test_queries_run_from_another_folder_without_a_search_path(tmp_path):
    (tmp_path / "work").mkdir()
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    run = subprocess.run([sys.executable, "-c", RUN, ROOT, str(tmp_path / "shared")], cwd=tmp_path / "work", env=env, capture_output=True, text=True, timeout=600)
    told = dict(x.rsplit(" ", 1) for x in run.stdout.split("\n") if x)
    assert run.returncode == 0, run.stderr[-3000:]
    assert told == {"op2_secret_scan": "200", "op13_source_mix": "200", "op9_quality_classifier": "200", "op12_fill_in_middle": "200",
                    "weeks_available": "True", "range": "10", "distinct": "1"}
