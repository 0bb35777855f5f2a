"""Time the headline queries and print one line of JSON.

Environment: BENCH_SF_DIR (tables, default sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (names
separated by commas, default the headline ones).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sparkmine.catalog.queries import QUERIES  # noqa: E402
from sparkmine.operators.storage import Workspace  # noqa: E402

HEADLINE = [
    "near_duplicates",
    "jaccard_pairs",
    "minhash_signatures",
    "lsh_quality",
    "frequent_itemsets",
    "association_rules",
    "triangles_exact",
    "triest_estimate",
    "triest_sweep",
    "triest_stream",
]


def session(cpus: str) -> SparkSession:
    folder = tempfile.mkdtemp(prefix="sparkmine-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.checkpoint.dir", folder)
        .appName("bench")
        .config("spark.driver.memory", "20g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    """Time to build and run a query, every row of it, with nothing kept from other queries."""
    start = time.perf_counter()
    with Workspace(spark):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    names = os.environ.get("BENCH_QUERIES")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    small = Path(sf_dir).parent / "sf0.001"
    if small.exists():  # starts the Python workers and compiles the hot classes
        for name in ("near_duplicates", "triest_estimate"):
            seconds(spark, name, str(small))
    times = {n: seconds(spark, n, sf_dir) for n in (names.split(",") if names else HEADLINE)}
    result = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    if {"jaccard_pairs", "near_duplicates"} <= times.keys():
        result["exact_over_lsh"] = round(times["jaccard_pairs"] / times["near_duplicates"], 2)
    if not names:
        errors = QUERIES["triest_error"](spark, sf_dir).select("size", "rel_error").collect()
        result["estimate_error_by_size"] = {str(r.size): r.rel_error for r in sorted(errors)}
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
