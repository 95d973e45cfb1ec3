"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.

Each query is executed in full with the ``noop`` sink (every row is produced,
nothing is collected to the driver). A small warm-up on the smallest scale
factor runs first so JVM start-up is not charged to the first query. Every
query runs ``$BENCH_REPEAT`` times (default 3, interleaved); the reported time
is the median, and all runs are listed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from contrail.plans.queries import QUERIES  # noqa: E402

HEADLINE = ["q03", "q04", "q07", "q08", "q10", "q13", "q14", "q17", "q18", "q25", "q26", "q27", "q28", "q30"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("contrail-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(max(8, int(cpus) * 2)))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.driver.memory", "16g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm):
        for n in ("q03", "q28"):
            QUERIES[n](spark, warm).write.format("noop").mode("overwrite").save()
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))
    runs = {n: [] for n in names}
    for _ in range(repeat):
        for n in names:
            t0 = time.perf_counter()
            QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs[n].append(round(time.perf_counter() - t0, 3))
    times = {n: statistics.median(v) for n, v in runs.items()}
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus),
                      "repeat": repeat, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
