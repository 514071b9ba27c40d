"""Report marts E1-E6 (the six CSV exports of the reference).

Money is summed as DECIMAL and cast to double at the end; ratios are
``ROUND(x / NULLIF(y, 0), 4)`` with the reports' half-away rounding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.operators.common import fact_without_dim_attrs, margin, money_sum, month_of, n_distinct, per_product


def kpi_overview(fact: DataFrame) -> DataFrame:
    """total_revenue, total_profit, total_orders, total_customers, profit_margin."""
    return fact.agg(
        money_sum("sales").alias("_rev"),
        money_sum("profit").alias("_pro"),
        n_distinct("order_id").alias("total_orders"),
        n_distinct("customer_id").alias("total_customers"),
    ).select(
        F.col("_rev").cast("double").alias("total_revenue"),
        F.col("_pro").cast("double").alias("total_profit"),
        "total_orders",
        "total_customers",
        margin("_pro", "_rev", 4).alias("profit_margin"),
    )


def monthly_sales_trends(fact: DataFrame) -> DataFrame:
    """Month, revenue, profit, orders, active_customers (month ascending)."""
    return (
        fact.groupBy(month_of("order_date").alias("month"))
        .agg(
            money_sum("sales").cast("double").alias("revenue"),
            money_sum("profit").cast("double").alias("profit"),
            n_distinct("order_id").alias("orders"),
            n_distinct("customer_id").alias("active_customers"),
        )
        .orderBy(F.col("month").asc_nulls_last())
    )


def product_performance(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Per product (distinct-grain dimension, so it may fan out).
    The fact is pre-aggregated per product before the join."""
    p = dim_product.select("product_id", "product_name", "category", "sub_category")
    return (
        per_product(fact).join(p, "product_id")
        .groupBy("product_id", "product_name", "category", "sub_category")
        .agg(
            F.sum("p_sales").alias("_rev"),
            F.sum("p_profit").alias("_pro"),
            F.sum("p_quantity").alias("units_sold"),
        )
        .select(
            "product_id", "product_name", "category", "sub_category",
            F.col("_rev").cast("double").alias("revenue"),
            F.col("_pro").cast("double").alias("profit"),
            "units_sold",
            margin("_pro", "_rev", 4).alias("profit_margin"),
        )
    )


def customer_loyalty(fact: DataFrame) -> DataFrame:
    """Per customer order count, lifetime money, first/last order date."""
    return fact.groupBy("customer_id").agg(
        n_distinct("order_id").alias("order_count"),
        money_sum("sales").cast("double").alias("lifetime_revenue"),
        money_sum("profit").cast("double").alias("lifetime_profit"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def regional_performance(fact: DataFrame, dim_customer: DataFrame, by_order: bool = False) -> DataFrame:
    """E5: market and region taken from the customer dimension (fans out when
    a customer has several regions - the reference's semantics).

    Lines are first reduced to one row per (customer, order); the distinct
    counts after the join are unchanged by that, and the join moves orders,
    not lines.  ``by_order``: ``fact`` has the order grain of ``GRAINS``, so
    its rows meet the dimension as they are."""
    f = fact_without_dim_attrs(fact, "region", "market")
    if by_order:
        f = f.select("customer_id", "order_id", F.col("sales").alias("o_sales"), F.col("profit").alias("o_profit"))
    else:
        f = f.groupBy("customer_id", "order_id").agg(F.sum("sales").alias("o_sales"), F.sum("profit").alias("o_profit"))
    c = dim_customer.select("customer_id", "market", "region")
    return (
        f.join(c, "customer_id")
        .groupBy("market", "region")
        .agg(
            F.sum("o_sales").cast("double").alias("revenue"),
            F.sum("o_profit").cast("double").alias("profit"),
            n_distinct("order_id").alias("orders"),
            n_distinct("customer_id").alias("customers"),
        )
    )


def discount_profitability(fact: DataFrame) -> DataFrame:
    """Per discount level; NULL discount is its own, last group.  The money
    is summed apart from the orders, whose (discount, order) rows are shuffled:
    in one aggregate each of them would carry its sums along."""
    pairs = fact.select(F.col("discount").alias("_of"), "order_id").distinct()
    orders = pairs.groupBy("_of").agg(F.count("order_id").alias("orders"))
    sums = fact.groupBy("discount").agg(money_sum("sales").alias("_rev"), money_sum("profit").alias("_pro"))
    return (
        sums.join(orders, F.col("discount").eqNullSafe(F.col("_of")))
        .select(
            F.col("discount").cast("double").alias("discount"),
            "orders",
            F.col("_rev").cast("double").alias("revenue"),
            F.col("_pro").cast("double").alias("profit"),
            margin("_pro", "_rev", 4).alias("profit_margin"),
        )
        .orderBy(F.col("discount").asc_nulls_last())
    )


def _grain(star) -> str | None:
    return star.grain if isinstance(star, _WithFact) else None


# Export registry: mart name -> (file name, builder over a Star, bounded?)
# Bounded marts (one row, or one per month / discount level) may be written
# as a single file; E3/E4 grow with the data and are written in parallel.
MARTS = {
    "kpi_overview": ("kpi_overview.csv", lambda s: kpi_overview(s.fact_sales), True),
    "monthly_sales_trends": ("monthly_sales_trends.csv", lambda s: monthly_sales_trends(s.fact_sales), True),
    "product_performance": (
        "product_performance.csv", lambda s: product_performance(s.fact_sales, s.dim_product), False),
    "customer_loyalty": ("customer_loyalty.csv", lambda s: customer_loyalty(s.fact_sales), False),
    "regional_performance": (
        "regional_performance.csv", lambda s: regional_performance(s.fact_sales, s.dim_customer, _grain(s) == "order"), True),
    "discount_profitability": ("discount_profitability.csv", lambda s: discount_profitability(s.fact_sales), True),
}

# What five of the marts start from when they are published together: the
# columns that the lines are summed by.
GRAINS = {"order": ["customer_id", "order_id", "order_date"], "product": ["product_id"]}
MART_GRAINS = {
    "kpi_overview": "order", "monthly_sales_trends": "order", "customer_loyalty": "order",
    "regional_performance": "order", "product_performance": "product",
}


def grain_sums(fact: DataFrame) -> DataFrame:
    """Exact sums of the lines at every grain of ``GRAINS``, from one read of
    the fact (grouping sets, summed map-side): column ``grain``, the grains'
    columns (NULL where a grain lacks them) and sales, profit, quantity."""
    columns = [c for key in GRAINS.values() for c in key]
    # bit k of the grouping id is set where the k-th column from the right is no part of the grain
    lacks = {name: sum(c not in key and 1 << (len(columns) - 1 - i) for i, c in enumerate(columns))
             for name, key in GRAINS.items()}
    grain = F.coalesce(*[F.when(F.col("_lacks") == bits, F.lit(name)) for name, bits in lacks.items()])
    return (
        fact.groupingSets([[F.col(c) for c in key] for key in GRAINS.values()], *[F.col(c) for c in columns])
        .agg(F.grouping_id().alias("_lacks"), money_sum("sales").alias("sales"), money_sum("profit").alias("profit"),
             F.sum(F.col("quantity").cast("bigint")).alias("quantity"))
        .select(grain.alias("grain"), *columns, "sales", "profit", "quantity")
    )


class _WithFact:
    """``star`` with the sums of a grain as its fact; its other tables are those
    of ``star``, asked for only when a mart reads them (a gradual warehouse
    writes no others)."""

    def __init__(self, star, grain: str, fact_sales: DataFrame):
        self._star, self.grain, self.fact_sales = star, grain, fact_sales

    def __getattr__(self, name: str):
        return getattr(self._star, name)


def rolled_up(star, path: str) -> dict:
    """{grain: ``star`` with that grain's sums as its fact}; the sums are
    written to ``path``, a folder for each grain.  Sums of exact sums are the
    sums of the lines, and every order, customer and date of the lines is in
    the order grain, so the marts of ``MART_GRAINS`` come out the same."""
    grain_sums(star.fact_sales).write.partitionBy("grain").parquet(path)
    sums = star.fact_sales.sparkSession.read.schema(grain_sums(star.fact_sales).schema).parquet(path)
    return {name: _WithFact(star, name, sums.where(F.col("grain") == name).select(*key, "sales", "profit", "quantity"))
            for name, key in GRAINS.items()}
