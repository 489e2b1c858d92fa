"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times; the best run counts. Results
go to the noop sink, so every row and column is computed and nothing is collected."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from given_tables.queries import QUERIES  # noqa: E402

HEADLINE = [
    "st7_contents", "j6_asof_dim", "w1_w3_neighbours", "w9_quintiles",
    "w9_quintiles_distributed", "w9_order_quintiles", "w9_order_quintiles_distributed",
    "scd1_snapshot_merge", "scd2_versions", "scd3_dimension",
    "scd4_dim_cuentas", "sub1_lifecycle", "rfm7_fact", "rpt1_enterprise", "ld4_upsert",
    "dq12_full_run", "crm2_match",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="abono-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took: dict[str, float] = {}
    for name in names:
        best = None
        for i in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds = time.perf_counter() - start
            if i and (best is None or seconds < best):
                best = seconds
        took[name] = round(best, 3)
        print(name, took[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds, warm", "value": round(sum(took.values()), 3), "unit": "sec",
        "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
