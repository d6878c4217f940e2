"""Python workers must not need kmstream installed (functions travel by value)."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
import __spark_entry__ as E
print("ROWS", E.queries()["elbow_scores"](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_arrow_path_runs_from_foreign_working_directory():
    with tempfile.TemporaryDirectory() as cwd:
        env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env,
                             capture_output=True, text=True, timeout=600)
    # 200 rows: the rule of thumb sweeps k = 1..10
    assert "ROWS 10" in out.stdout, out.stderr[-2000:]
