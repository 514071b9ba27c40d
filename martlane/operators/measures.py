"""Dashboard measures V1-V11: figures the reference reports on its
dashboard but computes in no query.  Definitions are ours (see README).

Each is a small aggregate over the fact; windows only ever run over
calendar-bounded aggregates (years, quarters, months) - never the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlane.functions.numeric import margin, pct
from martlane.operators.common import money_sum, n_distinct, on_calendar, per_product
from martlane.operators.marts import kpi_overview, product_performance

# Fixed value: the discount threshold the dashboard splits on (20 %).
DISCOUNT_BAND_LIMIT = 0.20


def average_order_value(fact: DataFrame) -> DataFrame:
    """V1: total_revenue, total_orders, average_order_value (2 dp)."""
    return fact.agg(money_sum("sales").alias("_rev"), n_distinct("order_id").alias("total_orders")).select(
        F.col("_rev").cast("double").alias("total_revenue"),
        "total_orders",
        margin("_rev", "total_orders", 2).alias("average_order_value"),
    )


def yearly_revenue(fact: DataFrame, calendar: bool = False) -> DataFrame:
    """V2: year, revenue, prev_year_revenue, yoy_pct (previous row = previous
    year present).  ``calendar``: years without lines have a row of revenue
    zero, the previous row is the year before, and the row of undated lines
    is compared with nothing."""
    w = Window.orderBy(F.col("year").asc_nulls_last())
    yearly = fact.groupBy(F.year("order_date").alias("year")).agg(money_sum("sales").alias("_rev"))
    dated = F.lit(True)
    if calendar:
        yearly, dated = on_calendar(yearly, "year", "1", ("_rev",)), F.col("year").isNotNull()
    return (
        yearly.select("year", "_rev", F.when(dated, F.lag("_rev", 1).over(w)).alias("_prev"))
        .select(
            "year",
            F.col("_rev").cast("double").alias("revenue"),
            F.col("_prev").cast("double").alias("prev_year_revenue"),
            pct(F.col("_rev") - F.col("_prev"), "_prev").alias("yoy_pct"),
        )
        .orderBy(F.col("year").asc_nulls_last())
    )


def monthly_revenue_by_year(fact: DataFrame) -> DataFrame:
    """V3: one row per year with the revenue of each month (m01 .. m12) and
    that of undated lines (in the row whose year is NULL)."""
    d = F.col("order_date")
    months = [F.sum(F.when(F.month(d) == m, F.col("sales"))).cast("double").alias(f"m{m:02d}") for m in range(1, 13)]
    undated = F.sum(F.when(d.isNull(), F.col("sales"))).cast("double").alias("undated")
    return fact.groupBy(F.year(d).alias("year")).agg(*months, undated).orderBy(F.col("year").asc_nulls_last())


def seasonality(fact: DataFrame) -> DataFrame:
    """Year, quarter, revenue, quarter_share (share of the year's revenue, 4 dp)."""
    q = fact.groupBy(F.year("order_date").alias("year"), F.quarter("order_date").alias("quarter")).agg(
        money_sum("sales").alias("_rev"))
    year_total = F.sum("_rev").over(Window.partitionBy("year"))
    return (
        q.select("year", "quarter", "_rev", year_total.alias("_year"))
        .select("year", "quarter", F.col("_rev").cast("double").alias("revenue"),
                margin("_rev", "_year", 4).alias("quarter_share"))
        .orderBy("year", "quarter")
    )


def peak_month_by_year(fact: DataFrame) -> DataFrame:
    """Year, peak_month, peak_revenue (ties: earliest month)."""
    m = fact.groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month")).agg(
        money_sum("sales").alias("_rev"))
    best = F.max_by(F.struct("month", "_rev"), F.struct(F.col("_rev"), (-F.col("month")).alias("_m")))
    return (
        m.groupBy("year").agg(best.alias("_b"))
        .select("year", F.col("_b.month").alias("peak_month"), F.col("_b._rev").cast("double").alias("peak_revenue"))
        .orderBy("year")
    )


def category_revenue(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """V5: category, revenue, profit, profit_margin (revenue descending);
    per-product pre-aggregation before the join."""
    p = dim_product.select("product_id", "category")
    return (
        per_product(fact).join(p, "product_id").groupBy("category")
        .agg(F.sum("p_sales").alias("_rev"), F.sum("p_profit").alias("_pro"))
        .select("category", F.col("_rev").cast("double").alias("revenue"),
                F.col("_pro").cast("double").alias("profit"), margin("_pro", "_rev", 4).alias("profit_margin"))
        .orderBy(F.col("revenue").desc_nulls_last(), "category")
    )


def category_margin_spread(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """V6: per category the spread of product margins and the share of
    products below 0 %: category, products, negative_margin_products,
    negative_share_pct, min_margin, max_margin."""
    pp = product_performance(fact, dim_product)
    return pp.groupBy("category").agg(
        F.count(F.lit(1)).alias("products"),
        F.count_if(F.col("profit_margin") < 0).alias("negative_margin_products"),
        F.min("profit_margin").alias("min_margin"),
        F.max("profit_margin").alias("max_margin"),
    ).select("category", "products", "negative_margin_products",
             pct("negative_margin_products", "products").alias("negative_share_pct"),
             "min_margin", "max_margin")


def customers_by_order_count(fact: DataFrame) -> DataFrame:
    """V7: histogram order_count -> customers."""
    per = fact.groupBy("customer_id").agg(n_distinct("order_id").alias("order_count"))
    return per.groupBy("order_count").agg(F.count(F.lit(1)).alias("customers")).orderBy("order_count")


def discount_bands(fact: DataFrame, limit: float = DISCOUNT_BAND_LIMIT) -> DataFrame:
    """V8: band ('none', 'up_to_20', 'over_20'), lines, revenue, profit, profit_margin."""
    d = F.col("discount")
    band = (F.when(d.isNull(), "none").when(d <= F.lit(limit), "up_to_20").otherwise("over_20"))
    return (
        fact.groupBy(band.alias("band"))
        .agg(F.count(F.lit(1)).alias("lines"), money_sum("sales").alias("_rev"), money_sum("profit").alias("_pro"))
        .select("band", "lines", F.col("_rev").cast("double").alias("revenue"),
                F.col("_pro").cast("double").alias("profit"), margin("_pro", "_rev", 4).alias("profit_margin"))
    )


def second_purchase(fact: DataFrame, days: int = 90) -> DataFrame:
    """V9: customers, repeat_customers, within_days, within_days_pct.

    A purchase is an order (its earliest line date; undated orders are
    ignored).  The second purchase is the next order by (date, order_id)
    after the first.  Orders are counted by customer and day before customers
    meet their first day, so a customer has a row per calendar day at most
    and none can be hot; NULL customers form one group.  The second purchase
    falls on the first day if that holds two orders, else on the next.
    """
    keys = ["_kn", "_kc"]
    by_day = (
        fact.filter(F.col("order_date").isNotNull())
        .select(F.col("customer_id").isNull().alias("_kn"), F.coalesce(F.col("customer_id"), F.lit("")).alias("_kc"),
                "order_id", "order_date")
        .groupBy(*keys, "order_id").agg(F.min("order_date").alias("d"))
        .groupBy(*keys, "d").agg(F.count(F.lit(1)).alias("orders"))
    )
    first = by_day.groupBy(*keys).agg(F.min("d").alias("first_d"))
    on_first = F.col("d") == F.col("first_d")
    per = by_day.join(first, keys).groupBy(*keys, "first_d").agg(
        F.min(F.when(~on_first | (F.col("orders") > 1), F.col("d"))).alias("second_d"))
    return per.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count("second_d").alias("repeat_customers"),
        F.count_if(F.date_diff("second_d", "first_d") <= days).alias("within_days"),
    ).select("customers", "repeat_customers", "within_days", pct("within_days", "customers").alias("within_days_pct"))


def kpi_excluding_returns(fact: DataFrame) -> DataFrame:
    """The KPI row over lines not flagged as returned."""
    return kpi_overview(fact.filter(~F.col("returned")))


def top_margin_product(fact: DataFrame, dim_product: DataFrame, n: int = 1) -> DataFrame:
    """Most profitable product(s) by margin (ties: revenue, product_id)."""
    return (
        product_performance(fact, dim_product)
        .select("product_id", "product_name", "category", "revenue", "profit", "profit_margin")
        .orderBy(F.col("profit_margin").desc_nulls_last(), F.col("revenue").desc_nulls_last(), "product_id")
        .limit(n)
    )
