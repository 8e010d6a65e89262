"""Python task code must run on workers that do not have this package on
their path (another working directory, a cluster node)."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as E
for q in ("html_links", "repr_cells"):
    n = E.queries()[q](spark, "/root/testdata/sf0.001").count()
    assert n > 0, q
print("DEPLOY-OK")
"""


def test_python_tasks_run_from_another_directory():
    cwd = tempfile.mkdtemp(prefix="tm-cwd-", dir="/tmp")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], cwd=cwd, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "DEPLOY-OK" in out.stdout, out.stderr[-2000:]
