"""Business analyses A1-A10.

Windows without PARTITION BY (A1, A2, A4) run on one task, so they are only
ever applied to an aggregate whose size is bounded by the calendar (one row
per month) or by the product taxonomy (one row per category) - never to the
fact itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlane.functions.numeric import pct, ratio
from martlane.operators.common import money_sum, month_of, n_distinct, on_calendar, per_product


def _monthly(fact: DataFrame, with_profit: bool = True) -> DataFrame:
    aggs = [money_sum("sales").alias("revenue")]
    if with_profit:
        aggs += [money_sum("profit").alias("profit"), n_distinct("order_id").alias("orders_count")]
    return fact.groupBy(month_of("order_date").alias("month")).agg(*aggs)


def monthly_growth(fact: DataFrame, calendar: bool = False) -> DataFrame:
    """A1: month, revenue, profit, orders_count, prev_month_revenue, mom_pct,
    revenue_last_year, yoy_pct.

    LAG(12) counts rows, not calendar months: a missing month shifts the
    year-over-year comparison (the reference's semantics).  ``calendar`` puts
    every month from the first to the last in its place, one without lines
    with revenue, profit and orders of zero, so that the comparisons meet the
    month before and the same month of the year before.  Undated lines keep
    their own, last row, which then is compared with nothing."""
    w = Window.orderBy(F.col("month").asc_nulls_last())
    months, dated = _monthly(fact), F.lit(True)
    if calendar:
        months = on_calendar(months, "month", "INTERVAL 1 MONTH", ("revenue", "profit", "orders_count"))
        dated = F.col("month").isNotNull()
    prev = F.when(dated, F.lag("revenue", 1).over(w))
    last_year = F.when(dated, F.lag("revenue", 12).over(w))
    return (
        months
        .select(
            "month", "revenue", "profit", "orders_count",
            prev.alias("_prev"), last_year.alias("_ly"),
        )
        .select(
            "month",
            F.col("revenue").cast("double").alias("revenue"),
            F.col("profit").cast("double").alias("profit"),
            "orders_count",
            F.col("_prev").cast("double").alias("prev_month_revenue"),
            pct(F.col("revenue") - F.col("_prev"), "_prev").alias("mom_pct"),
            F.col("_ly").cast("double").alias("revenue_last_year"),
            pct(F.col("revenue") - F.col("_ly"), "_ly").alias("yoy_pct"),
        )
        .orderBy(F.col("month").asc_nulls_last())
    )


def cumulative_revenue(fact: DataFrame) -> DataFrame:
    """A2: month, cumulative_revenue (RANGE frame, summed as DECIMAL)."""
    w = Window.orderBy(F.col("month").asc_nulls_last()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        _monthly(fact, with_profit=False)
        .select("month", F.sum("revenue").over(w).cast("double").alias("cumulative_revenue"))
        .orderBy(F.col("month").asc_nulls_last())
    )


def top_products(fact: DataFrame, dim_product: DataFrame, n: int = 10) -> DataFrame:
    """A3: top-n products by revenue (ties: product_id, product_name).

    avg_discount is the exact decimal mean rounded to 3 places (the
    reference's ``::numeric`` cast), reported as double.  The fact is
    pre-aggregated per product before the join."""
    p = dim_product.select("product_id", "product_name")
    n_disc = F.sum("p_discount_n")
    return (
        per_product(fact, with_discount=True).join(p, "product_id")
        .groupBy("product_id", "product_name")
        .agg(
            F.sum("p_sales").alias("_rev"),
            F.sum("p_profit").alias("_pro"),
            (F.sum("p_discount_sum").cast("decimal(18,2)") / F.nullif(n_disc, F.lit(0))).alias("_avg_disc"),
            F.sum("p_quantity").alias("units_sold"),
        )
        .select(
            "product_id", "product_name",
            F.col("_rev").cast("double").alias("total_revenue"),
            F.col("_pro").cast("double").alias("total_profit"),
            pct("_pro", "_rev").alias("profit_margin_pct"),
            F.col("_avg_disc").cast("decimal(18,3)").cast("double").alias("avg_discount"),
            "units_sold",
        )
        .orderBy(F.col("total_revenue").desc_nulls_last(), "product_id", "product_name")
        .limit(n)
    )


def category_contribution(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """A4: category, cat_sales, pct_of_total, cumulative_share (by sales desc;
    ties by category).  Per-product pre-aggregation before the join."""
    p = dim_product.select("product_id", "category")
    cat = per_product(fact).join(p, "product_id").groupBy("category").agg(F.sum("p_sales").alias("cat_sales"))
    order = [F.col("cat_sales").desc_nulls_last(), F.col("category").asc_nulls_last()]
    total = F.sum("cat_sales").over(Window.partitionBy())
    running = F.sum("cat_sales").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return (
        cat.select("category", "cat_sales", total.alias("_total"), running.alias("_run"))
        .select(
            "category",
            F.col("cat_sales").cast("double").alias("cat_sales"),
            pct("cat_sales", "_total").alias("pct_of_total"),
            ratio("_run", "_total").alias("cumulative_share"),
        )
        .orderBy(*order)
    )


def rfm(fact: DataFrame, n: int = 100) -> DataFrame:
    """A5: recency / frequency / monetary per customer, top-n by monetary.

    Recency is measured against the fact's own latest order date: a global
    max (per-partition partials, one row out) attached with a 1-row
    broadcast cross join - no second shuffle by customer."""
    cust = fact.groupBy("customer_id").agg(
        F.max("order_date").alias("last_order_date"),
        n_distinct("order_id").alias("frequency"),
        money_sum("sales").alias("_monetary"),
    )
    params = fact.agg(F.max("order_date").alias("_analysis_date"))
    return (
        cust.crossJoin(F.broadcast(params))
        .select(
            "customer_id",
            "last_order_date",
            F.date_diff("_analysis_date", "last_order_date").cast("bigint").alias("recency_days"),
            "frequency",
            F.col("_monetary").cast("double").alias("monetary"),
        )
        .orderBy(F.col("monetary").desc_nulls_last(), F.col("customer_id").asc_nulls_last())
        .limit(n)
    )


def repeat_purchase_rate(fact: DataFrame) -> DataFrame:
    """repeat_customers, total_customers, repeat_pct (customers with > 1 order)."""
    per_cust = fact.groupBy("customer_id").agg(n_distinct("order_id").alias("order_count"))
    return per_cust.agg(
        F.sum(F.when(F.col("order_count") > 1, 1).otherwise(0)).cast("bigint").alias("repeat_customers"),
        F.count(F.lit(1)).alias("total_customers"),
    ).select("repeat_customers", "total_customers", pct("repeat_customers", "total_customers").alias("repeat_pct"))


def cohort_retention(fact: DataFrame, k: int = 1) -> DataFrame:
    """cohort_month, cohort_size, retained_next_month, retention_next_month_pct.

    Cohort = month of a customer's first order; retained = ordered again in
    cohort_month + k months.  The join adds ``order_month = cohort + k`` to
    the key, so each customer meets at most one customer-month row and both
    distinct counts become plain counts (same numbers, no Expand).  NULL
    customers form a cohort of size 0 (pct NULL), as in the reference.
    """
    first = fact.groupBy("customer_id").agg(F.trunc(F.min("order_date"), "MM").alias("cohort_month"))
    months = fact.select(
        F.col("customer_id").alias("_cid"), month_of("order_date").alias("order_month")
    ).distinct()
    hit = first.join(
        months,
        (first.customer_id == months._cid) & (months.order_month == F.add_months(first.cohort_month, k)),
        "left",
    )
    return (
        hit.groupBy("cohort_month")
        .agg(F.count("customer_id").alias("cohort_size"), F.count("_cid").alias("retained_next_month"))
        .select(
            "cohort_month", "cohort_size", "retained_next_month",
            pct("retained_next_month", "cohort_size").alias("retention_next_month_pct"),
        )
        .orderBy(F.col("cohort_month").asc_nulls_last())
    )


def regional_leaderboard(fact: DataFrame) -> DataFrame:
    """Region, revenue, profit, profit_margin_pct, unique_customers."""
    return (
        fact.groupBy("region")
        .agg(
            money_sum("sales").alias("_rev"),
            money_sum("profit").alias("_pro"),
            n_distinct("customer_id").alias("unique_customers"),
        )
        .select(
            "region",
            F.col("_rev").cast("double").alias("revenue"),
            F.col("_pro").cast("double").alias("profit"),
            pct("_pro", "_rev").alias("profit_margin_pct"),
            "unique_customers",
        )
        .orderBy(F.col("revenue").desc_nulls_last(), F.col("region").asc_nulls_last())
    )


def state_performance(fact: DataFrame, dim_customer_key: DataFrame, region: str, n: int = 20) -> DataFrame:
    """Top-n states of one region (fact region filter pushed to the scan;
    lines pre-aggregated per customer; state from the keyed customer
    dimension)."""
    f = (
        fact.filter(F.col("region") == F.lit(region))
        .groupBy("customer_id")
        .agg(F.sum("sales").alias("c_sales"), F.sum("profit").alias("c_profit"))
    )
    c = dim_customer_key.select("customer_id", "state")
    return (
        f.join(c, "customer_id")
        .groupBy("state")
        .agg(F.sum("c_sales").alias("_rev"), F.sum("c_profit").alias("_pro"))
        .select(
            "state",
            F.col("_rev").cast("double").alias("revenue"),
            F.col("_pro").cast("double").alias("profit"),
            pct("_pro", "_rev").alias("margin"),
        )
        .orderBy(F.col("revenue").desc_nulls_last(), F.col("state").asc_nulls_last())
        .limit(n)
    )


def return_rate_by_region(fact: DataFrame) -> DataFrame:
    """A10: region, return_count, order_rows, return_pct (line level)."""
    return (
        fact.groupBy("region")
        .agg(F.count_if(F.col("returned")).alias("return_count"), F.count(F.lit(1)).alias("order_rows"))
        .select("region", "return_count", "order_rows", pct("return_count", "order_rows").alias("return_pct"))
        .orderBy(F.col("return_pct").desc_nulls_last(), F.col("region").asc_nulls_last())
    )
