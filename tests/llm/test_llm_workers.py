"""Python workers need no copy of the package: every registered query, from a foreign folder."""

import os
import subprocess
import sys

import pytest

from kmstream.llm.queries import QUERIES

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
from kmstream.llm.queries import QUERIES
for name, run in QUERIES.items():
    print("ROWS", name, run(spark, "/root/testdata/sf0.001").count(), flush=True)
spark.stop()
"""


@pytest.fixture(scope="module")
def printed(tmp_path_factory):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO)], cwd=tmp_path_factory.mktemp("elsewhere"), env=env,
                         capture_output=True, text=True, timeout=1800)
    return {x.split()[1]: int(x.split()[2]) for x in out.stdout.splitlines() if x.startswith("ROWS")}, out.stderr


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_without_the_package_on_workers(printed, name):
    rows, errors = printed
    assert rows.get(name, 0) > 0, errors[-2000:]
