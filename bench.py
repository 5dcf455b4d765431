"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS (default 8) the local threads.
Each query runs BENCH_RUNS times (default 2) into a no-op sink; the fastest run counts.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from siteloom.plans.queries import registry
from siteloom.session import configure

HEADLINE = [
    "call_stats",
    "hwe",
    "site_lookup",
    "site_qc",
    "range_join_features",
    "nearest_genes",
    "nearest_genes_salted",
    "annotate_full",
    "ld_r2",
    "ld_prune",
    "mean_impute",
    "ss_qc",
    "liftover",
    "left_align",
    "harmonised",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus, runs = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("siteloom-bench")
        .config("spark.sql.shuffle.partitions", os.environ.get("BENCH_PARTITIONS", "16"))
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="siteloom-bench-"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    known, seconds = registry(), {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        times = []
        for _ in range(runs):
            begun = time.perf_counter()
            known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begun)
        seconds[name] = round(min(times), 3)
    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
