"""Benchmark: builds the warehouse from the driver tables, then times every
registered query.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query, default 3; one warm-up run first),
BENCH_EVENT_LOG (optional folder for Spark's event log).

Each query is executed fully with the ``noop`` sink (no collect to the
driver).  Prints ONE JSON line on stdout:
{"metric": ..., "value": total seconds, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None

    from martlane.session import get_session

    conf = {"spark.driver.memory": "16g", "spark.sql.files.maxPartitionBytes": str(64 << 20)}
    if os.environ.get("BENCH_EVENT_LOG"):
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]})
    spark = get_session(f"local[{cpus}]", app_name="martlane-bench", shuffle_partitions=cpus * 2, conf=conf)

    from martlane.plans.registry import QUERIES
    from martlane.plans.warehouse import star_for

    from martlane.plans.extract_store import extracts_for

    timings: dict[str, float] = {}
    t0 = time.perf_counter()
    # data preparation: the three extracts (and the seeded-dirt Orders
    # variant) derived from the driver tables, written once as files
    extracts_for(spark, sf_dir, rewrite=True)
    extracts_for(spark, sf_dir, dirty=True, rewrite=True)
    timings["extract_files"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    star_for(spark, sf_dir, rebuild=True)  # fresh: clean -> write raw_orders -> build and write the star
    timings["warehouse_build"] = round(time.perf_counter() - t0, 3)
    print(f"extract_files {timings['extract_files']}s warehouse_build {timings['warehouse_build']}s", file=sys.stderr)

    for key, fn in QUERIES.items():
        def run() -> float:
            s = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - s

        run()  # warm-up
        t = statistics.median(run() for _ in range(runs))
        timings[key] = round(t, 3)
        print(f"{key} {t:.3f}s", file=sys.stderr)

    total = round(sum(timings.values()), 3)
    print(json.dumps({
        "metric": "extract files + warehouse build + sum of median per-query seconds (all registered queries)",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "sf": sf,
        "cpus": cpus,
        "runs": runs,
        "n_queries": len(QUERIES),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
