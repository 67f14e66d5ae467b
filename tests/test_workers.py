from __future__ import annotations

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
DATA = "/root/testdata/sf0.001"

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as contract
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for name in ("search_vector_topk", "page_links", "answer_batch", "index_refresh_log"):
    assert contract.queries()[name](spark, sys.argv[2]).count() > 0, name
"""


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no data folder")
def test_workers_need_no_installed_package(tmp_path):
    """Only the driver process has the package on its path, and the session is a plain one."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, REPO, DATA], cwd=tmp_path, env=env, capture_output=True, timeout=300
    )
    assert done.returncode == 0, done.stderr.decode()[-3000:]
