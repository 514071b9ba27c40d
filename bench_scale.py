"""Scaling run: the production path (read extracts -> clean -> build ->
reports) on k-fold copies of the driver data.

The Orders / Returns extracts derived from the driver tables are written k
times over as multi-file Parquet (each copy gets its own order and customer
keys; products are shared, so every product grows k times hotter).  Then
the pipeline runs from those files exactly as from real extracts, and the
build and a set of reports are timed per k.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8),
SCALE_FACTORS (default "1,4,16"), SCALE_DIR (scratch folder; default a new
folder under the checkpoint dir).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

REPORTS = ["kpi_overview", "monthly_sales_trends", "product_performance", "customer_loyalty",
           "regional_performance", "monthly_growth", "top_products", "rfm", "cohort_retention",
           "second_purchase_90d", "dq_summary"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    ks = [int(x) for x in os.environ.get("SCALE_FACTORS", "1,4,16").split(",")]

    from pyspark.sql import functions as F

    from martlane.session import checkpoint_root, get_session

    spark = get_session(f"local[{cpus}]", app_name="martlane-scale", shuffle_partitions=cpus * 4,
                        conf={"spark.driver.memory": "16g"})
    scratch = os.environ.get("SCALE_DIR") or f"{checkpoint_root(spark)}/martlane-scale/{spark.sparkContext.applicationId}"

    from martlane.plans.registry import QUERIES
    from martlane.plans.warehouse import build_warehouse, register_star
    from martlane.sources.driver import Extracts, driver_extracts
    from martlane.sources.extracts import read_orders, read_people, read_returns
    from martlane.sources.sinks import write_parquet

    base = driver_extracts(spark, sf_dir)
    results = {}
    for k in ks:
        copy = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_copy")
        suffix = F.concat(F.lit("-"), F.col("_copy").cast("string"))
        orders = (base.orders.select("*", copy)
                  .withColumn("row_id", F.col("row_id") * k + F.col("_copy"))
                  .withColumn("order_id", F.concat(F.col("order_id"), suffix))
                  .withColumn("customer_id", F.concat(F.col("customer_id"), suffix))
                  .drop("_copy"))
        returns = (base.returns.select("*", copy)
                   .withColumn("order_id", F.concat(F.col("order_id"), suffix)).drop("_copy"))
        d = f"{scratch}/k{k}"
        # data preparation (not timed): files with 8 * k parts, as extracts would arrive
        write_parquet(orders.repartition(8 * k), f"{d}/orders")
        write_parquet(returns.repartition(max(1, 2 * k)), f"{d}/returns")
        write_parquet(base.people, f"{d}/people")

        ex = Extracts(read_orders(spark, f"{d}/orders", "parquet"), read_returns(spark, f"{d}/returns", "parquet"),
                      read_people(spark, f"{d}/people", "parquet"))
        t0 = time.perf_counter()
        star = build_warehouse(spark, ex, f"{d}/warehouse")
        build = time.perf_counter() - t0
        lines = star.fact_sales.count()

        register_star(spark, f"{d}/src", star)
        times = {}
        for key in REPORTS:
            fn = QUERIES[key]
            runs = []
            for _ in range(3):
                s = time.perf_counter()
                fn(spark, f"{d}/src").write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - s)
            times[key] = round(statistics.median(runs[1:]), 3)
        results[k] = {"lines": lines, "build_sec": round(build, 2), "reports_sec": round(sum(times.values()), 2),
                      "per_query": times}
        print(f"k={k} lines={lines} build={build:.1f}s reports={sum(times.values()):.1f}s", file=sys.stderr)
    print(json.dumps({"metric": "scaling: build and report seconds per k-fold input", "sf_dir": sf_dir,
                      "cpus": cpus, "results": results}))
    spark.stop()


if __name__ == "__main__":
    main()
