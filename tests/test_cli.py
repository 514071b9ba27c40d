"""End-to-end through the command line: clean -> build -> export -> report."""

from __future__ import annotations

import json
import os

from conftest import SF_SMALL
from martlane.__main__ import main
from martlane.sources.driver import driver_extracts
from martlane.sources.sinks import write_csv


def test_clean_build_export_report(spark, scratch, capsys):
    ex = driver_extracts(spark, SF_SMALL)
    headers = {"row_id": "Row ID", "order_id": "Order ID", "sub_category": "Sub-Category"}
    orders = ex.orders.toDF(*[headers.get(c, c.replace("_", " ").title()) for c in ex.orders.columns])
    write_csv(orders, f"{scratch}/in/orders")
    write_csv(ex.returns, f"{scratch}/in/returns", single_file=True)
    write_csv(ex.people, f"{scratch}/in/people", single_file=True)

    assert main(["clean", "--orders", f"{scratch}/in/orders", "--returns", f"{scratch}/in/returns",
                 "--people", f"{scratch}/in/people", "--out", f"{scratch}/processed"]) == 0
    counters = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert counters["input.rows"] == ex.orders.count()
    assert main(["build", "--clean", f"{scratch}/processed/cleaned_orders.parquet",
                 "--warehouse", f"{scratch}/wh"]) == 0
    out = capsys.readouterr().out
    assert '"check": "orders_raw_count"' in out
    assert main(["export", "--warehouse", f"{scratch}/wh", "--out", f"{scratch}/marts"]) == 0
    assert "kpi_overview.csv" in capsys.readouterr().out
    assert os.path.isdir(f"{scratch}/marts/customer_loyalty.csv")
    assert main(["report", "--warehouse", f"{scratch}/wh", "--name", "repeat_purchase_rate"]) == 0
    row = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert row["total_customers"] > 0
    orders = spark.read.parquet(f"{scratch}/wh/fact_sales").select("customer_id").distinct().count()
    assert main(["report", "--warehouse", f"{scratch}/wh", "--name", "customer_loyalty"]) == 0
    assert len(capsys.readouterr().out.strip().splitlines()) == orders  # whole
    assert main(["report", "--warehouse", f"{scratch}/wh", "--name", "customer_loyalty", "--limit", "3"]) == 0
    shown = capsys.readouterr()
    assert len(shown.out.strip().splitlines()) == 3 and "not shown" in shown.err
    assert main(["report", "--warehouse", f"{scratch}/wh", "--name", "state_performance", "--out", f"{scratch}/sp"]) == 0
    assert spark.read.parquet(f"{scratch}/sp").count() > 0


def test_missing_input_exit_code(scratch):
    assert main(["build", "--clean", f"{scratch}/none", "--warehouse", f"{scratch}/wh"]) == 1


def test_clean_from_parquet_with_text_dates(spark, scratch, capsys):
    from pyspark.sql import functions as F

    ex = driver_extracts(spark, SF_SMALL)
    serial = F.date_diff(F.col("order_date"), F.lit("1899-12-30").cast("date")).cast("string")
    ex.orders.withColumn("order_date", serial).write.parquet(f"{scratch}/pq/orders")
    ex.returns.write.parquet(f"{scratch}/pq/returns")
    ex.people.write.parquet(f"{scratch}/pq/people")
    assert main(["clean", "--orders", f"{scratch}/pq/orders", "--returns", f"{scratch}/pq/returns",
                 "--people", f"{scratch}/pq/people", "--out", f"{scratch}/out", "--fmt", "parquet",
                 "--dates-as-string"]) == 0
    capsys.readouterr()
    cleaned = spark.read.parquet(f"{scratch}/out/cleaned_orders.parquet")
    assert dict(cleaned.dtypes)["order_date"] == "date"
    got = cleaned.select("row_id", "order_date").exceptAll(ex.orders.select("row_id", "order_date"))
    assert got.count() == 0  # serial numbers came back as the original dates
