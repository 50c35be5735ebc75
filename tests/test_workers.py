"""Code that runs in Python workers must not need this package on their path."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})          # the driver can import the package; workers cannot
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as E
n = E.queries()["retrieve_top_k"](spark, "/root/testdata/sf0.001").count()
print("HITS", n)
spark.stop()
"""


def test_retrieval_runs_where_workers_cannot_import_the_package():
    cwd = tempfile.mkdtemp(prefix="tidemark-cwd-")    # a fresh empty folder per run, left in place
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True,
                         text=True, timeout=600)
    assert "HITS 10" in out.stdout, out.stderr[-2000:]
