"""Executors need no copy of the package: workers that cannot import it run every operator that uses Python."""

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys

sys.path.insert(0, {repo!r})  # of the driver only
from pyspark.sql import SparkSession

import __spark_entry__ as entry_points

spark = (
    SparkSession.builder.master("local[4]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.driver.memory", "4g")
    .getOrCreate()
)


def found(_):
    import importlib.util

    yield importlib.util.find_spec("sparkmine") is not None


assert not any(spark.sparkContext.parallelize([0], 1).mapPartitions(found).collect())
for name, query in entry_points.queries().items():
    if name == "pipeline" or name.startswith("op"):
        rows = query(spark, {sf_dir!r}).count()
        print(name, rows)
        assert rows or name.startswith("op7")
print("all ran")
"""


def test_workers_without_the_package(sf_dir, tmp_path, monkeypatch):
    monkeypatch.delenv("PYTHONPATH", raising=False)
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(repo=str(REPO), sf_dir=sf_dir))
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=900)
    assert done.stdout.endswith("all ran\n"), done.stdout[-500:] + done.stderr[-3000:]
