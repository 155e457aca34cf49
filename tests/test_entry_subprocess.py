"""The driver imports __spark_entry__ from elsewhere: Python-worker operators must
still find the package (it is shipped to the workers)."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as e
assert e.entry(spark).count() >= 0
q = e.queries()
for name in ("fit_background", "spike_counts"):
    assert q[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("OK")
"""


def test_entry_from_another_directory():
    with tempfile.TemporaryDirectory() as d:
        env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=d, env=env, capture_output=True, text=True, timeout=600)
    assert r.returncode == 0 and "OK" in r.stdout, r.stderr[-2000:]
