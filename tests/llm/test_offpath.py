"""Every numbered query and the pipeline where workers cannot import this package."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})          # the driver can import the package; workers cannot
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
import __spark_entry__ as E
for name, run in E.queries().items():
    if name == "pipeline" or (name.startswith("op") and name[2].isdigit()):
        print("ROWS", name, run(spark, "/root/testdata/sf0.001").count(), flush=True)
spark.stop()
"""


def test_numbered_queries_run_where_workers_cannot_import_the_package():
    cwd = tempfile.mkdtemp(prefix="tidemark-cwd-")    # a fresh empty folder per run, left in place
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True, timeout=1500)
    rows = dict(line.split()[1:] for line in out.stdout.splitlines() if line.startswith("ROWS"))
    assert len(rows) == 14 and all(int(n) > 0 for n in rows.values()), out.stderr[-3000:]
