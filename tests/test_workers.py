"""Task functions travel with the job: Python workers need neither the package nor its folder."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from __spark_entry__ import entry, queries
assert entry(spark).first().n == 500
for name in ("hybrid_predict", "score_head", "topk_blocked"):
    assert queries()[name](spark, "/root/testdata/sf0.001").count() > 0
print("all ran")
"""


def test_package_is_not_needed_on_workers(tmp_path):
    repo = str(Path(__file__).resolve().parent.parent)
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=repo)], cwd=tmp_path, capture_output=True, text=True, timeout=240
    )
    assert "all ran" in done.stdout, done.stderr[-2000:]
