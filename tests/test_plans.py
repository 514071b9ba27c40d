"""Plan checks: built-ins only, filters and projections reach the scan,
no cartesian product other than the 1-row one, single-partition exchanges
only above aggregates."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
from martlane.plans import inspect as P
from martlane.plans.registry import QUERIES

ONE_ROW_PARAMETER_JOINS = {"rfm", "dq_orders_vs_returns", "dq_orders_vs_returns_extract", "dq_summary", "defects_dq_summary"}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_plan_shape(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    assert P.python_nodes(df) == []
    if P.cartesian_joins(df):
        assert key in ONE_ROW_PARAMETER_JOINS, key
    assert P.single_partition_exchanges_not_over_aggregate(df) == [], key


def test_region_filter_pushed_to_scan(spark):
    df = QUERIES["state_performance"](spark, SF_SMALL)
    assert any("EqualTo(region,AMERICA)" in f for f in P.pushed_filters(df))


def test_kpi_reads_only_needed_columns(spark):
    df = QUERIES["kpi_overview"](spark, SF_SMALL)
    assert P.scan_columns(df) == ["struct<order_id:string,customer_id:string,sales:decimal(18,2),profit:decimal(18,2)>"]


def test_python_udf_is_detected(spark):
    from pyspark.sql import functions as F

    slow = F.udf(lambda x: x, "long")
    assert P.python_nodes(spark.range(3).select(slow("id"))) != []


@pytest.mark.parametrize("key", ["dim_customer_key", "dim_product_key"])
def test_keyed_dimensions_hash_aggregate_the_lines(spark, key):
    """What meets the sorting aggregate is already one row per key, attributes
    and date."""
    from martlane.operators.star import build_dim_customer, build_dim_product
    from martlane.plans.warehouse import star_for

    raw = star_for(spark, SF_SMALL).raw_orders
    df = (build_dim_customer if "customer" in key else build_dim_product)(raw, "key")
    plan = P.physical_plan(df).splitlines()
    scan = next(i for i, line in enumerate(plan) if "FileScan" in line)
    nearest = next(line for line in reversed(plan[:scan]) if "Aggregate" in line)
    assert "HashAggregate" in nearest and "min(row_id" in nearest


def test_second_purchase_joins_day_grain_rows(spark):
    from martlane.operators.measures import second_purchase
    from martlane.plans.warehouse import star_for

    plan = P.physical_plan(second_purchase(star_for(spark, SF_SMALL).fact_sales))
    assert "SortAggregate" not in plan


def test_monthly_revenue_by_year_needs_no_job(spark):
    from martlane.operators.measures import monthly_revenue_by_year
    from martlane.plans.warehouse import star_for

    fact = star_for(spark, SF_SMALL).fact_sales
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("pivot", "pivot")
    try:
        df = monthly_revenue_by_year(fact)
        assert list(tracker.getJobIdsForGroup("pivot")) == []
    finally:
        spark.sparkContext.setJobGroup("rest", "rest")
    assert df.columns == ["year", *(f"m{m:02d}" for m in range(1, 13)), "undated"]
