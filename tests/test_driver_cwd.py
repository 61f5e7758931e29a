"""The driver imports __spark_entry__ by path from any folder: Python
workers must not need the package on their import path."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4") \\
    .config("spark.ui.enabled", "false").getOrCreate()
spec = importlib.util.spec_from_file_location("entry_mod", "{ROOT}/__spark_entry__.py")
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
print("ROWS", E.entry(spark).count())
"""


def test_entry_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=600)
    rows = [l for l in out.stdout.splitlines() if l.startswith("ROWS")]
    assert rows and int(rows[0].split()[1]) > 0, out.stderr[-2000:]
