"""Query registry: key -> callable(spark, sf_dir) -> DataFrame.

Reports run over the materialised warehouse built from the driver tables
(``plans.warehouse.star_for``); the cleaning rules act on the extracts
themselves and read the extract files (``plans.extract_store``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlane.operators import analysis as A
from martlane.operators import marts as E
from martlane.operators import measures as V
from martlane.operators import quality as D
from martlane.operators.load import derive_people, derive_returns
from martlane.operators.star import Star
from martlane.plans.warehouse import star_for
from martlane.schemas import PRIMARY_KEYS

QueryFn = Callable[[SparkSession, str], DataFrame]

# Parameters the driver data needs (FIXTURES.md §2).
STATE_REGION = "AMERICA"


def _star(fn, defects: bool = False):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(star_for(spark, sf_dir, defects=defects))

    run.__doc__ = fn.__doc__
    return run


# Load-time columns that never enter an oracle comparison.
LOAD_COLUMNS = ("created_at",)


def comparable(df: DataFrame) -> DataFrame:
    """Drop load stamps; DECIMAL -> double at the boundary."""
    cols = []
    for f in df.schema.fields:
        if f.name in LOAD_COLUMNS:
            continue
        c = F.col(f.name)
        cols.append(c.cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else c)
    return df.select(*cols)


def _key_tables(s):
    # written first: the other two start from their versions
    by_key = s.dim_customer_key, s.dim_product_key
    return {
        "dim_date": (s.dim_date, PRIMARY_KEYS["dim_date"]),
        "dim_customer": (s.dim_customer, PRIMARY_KEYS["dim_customer"]),
        "dim_customer_key": (by_key[0], PRIMARY_KEYS["dim_customer"]),
        "dim_product": (s.dim_product, PRIMARY_KEYS["dim_product"]),
        "dim_product_key": (by_key[1], PRIMARY_KEYS["dim_product"]),
        "dim_people": (s.dim_people, PRIMARY_KEYS["dim_people"]),
        # sales_id is dense by construction; the line's own key need not be unique
        "fact_sales": (s.fact_sales, ["row_id"]),
    }


# Periods without lines, which the calendar reports have to put back.
GAP_MONTHS = (2, 3, 9)
GAP_YEARS = (1993, 1994, 1997)


def _without_months(fact: DataFrame) -> DataFrame:
    day = F.col("order_date")
    return fact.where(day.isNull() | ~F.month(day).isin(*GAP_MONTHS))


def _without_years(fact: DataFrame) -> DataFrame:
    day = F.col("order_date")
    return fact.where(day.isNull() | ~F.year(day).isin(*GAP_YEARS))


def _orders_vs_returns_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martlane.plans.extract_store import extracts_for

    returns = extracts_for(spark, sf_dir).returns  # written first, so that the warehouse reads them
    return D.orders_vs_returns(star_for(spark, sf_dir).raw_orders, returns)


# One registry for queries and command-line reports: key -> fn(star).
STAR_REPORTS: dict[str, Callable[[Star], DataFrame]] = {
    # S5/S6 scan of the loaded staging table, S7/S8 derived staging tables
    "scan_raw_orders": lambda s: comparable(s.raw_orders),
    "derive_returns": lambda s: derive_returns(s.raw_orders),
    "derive_people": lambda s: derive_people(s.raw_orders),
    # T1-T5 star schema (load stamps left out)
    "dim_date": lambda s: comparable(s.dim_date),
    "dim_customer": lambda s: comparable(s.dim_customer),
    "dim_customer_key": lambda s: comparable(s.dim_customer_key),
    "dim_product": lambda s: comparable(s.dim_product),
    "dim_product_key": lambda s: comparable(s.dim_product_key),
    "dim_people": lambda s: comparable(s.dim_people),
    "fact_sales": lambda s: comparable(s.fact_sales),
    # D1-D12 quality checks, K1 key checks, S18 table counts
    "dq_row_counts": lambda s: D.row_counts(s.raw_orders, s.raw_returns, s.raw_people),
    "dq_missing_keys": lambda s: D.missing_keys(s.raw_orders),
    "dq_duplicate_row_id": lambda s: D.duplicate_row_id(s.raw_orders, 50),
    "dq_duplicate_lines": lambda s: D.duplicate_lines(s.raw_orders, 50),
    "dq_negative_values": lambda s: D.negative_values(s.raw_orders),
    "dq_invalid_discount": lambda s: D.invalid_discount(s.raw_orders),
    "dq_category_distribution": lambda s: D.category_distribution(s.raw_orders, 10),
    "dq_market_distribution": lambda s: D.market_distribution(s.raw_orders),
    "dq_returned_values": lambda s: D.returned_values(s.raw_returns),
    "dq_orders_vs_returns": lambda s: D.orders_vs_returns(s.raw_orders, s.raw_returns),
    "dq_null_distribution": lambda s: D.null_distribution(s.raw_orders),
    "dq_summary": lambda s: D.summary(s.raw_orders),
    "quality_report": lambda s: D.quality_report(s.raw_orders, s.raw_returns, s.raw_people),
    "key_checks": lambda s: D.key_checks(_key_tables(s)),
    "table_counts": lambda s: D.table_counts(s.fact_sales.sparkSession, {
        "fact_sales": s.fact_sales, "dim_date": s.dim_date, "dim_customer": s.dim_customer,
        "dim_product": s.dim_product, "dim_people": s.dim_people}),
    # E1-E6 report marts
    "kpi_overview": lambda s: E.kpi_overview(s.fact_sales),
    "monthly_sales_trends": lambda s: E.monthly_sales_trends(s.fact_sales),
    "product_performance": lambda s: E.product_performance(s.fact_sales, s.dim_product),
    "customer_loyalty": lambda s: E.customer_loyalty(s.fact_sales),
    "regional_performance": lambda s: E.regional_performance(s.fact_sales, s.dim_customer),
    "discount_profitability": lambda s: E.discount_profitability(s.fact_sales),
    # A1-A10 analyses
    "monthly_growth": lambda s: A.monthly_growth(s.fact_sales),
    "monthly_growth_calendar": lambda s: A.monthly_growth(_without_months(s.fact_sales), calendar=True),
    "cumulative_revenue": lambda s: A.cumulative_revenue(s.fact_sales),
    "top_products": lambda s: A.top_products(s.fact_sales, s.dim_product, 10),
    "category_contribution": lambda s: A.category_contribution(s.fact_sales, s.dim_product),
    "rfm": lambda s: A.rfm(s.fact_sales, 100),
    "repeat_purchase_rate": lambda s: A.repeat_purchase_rate(s.fact_sales),
    "cohort_retention": lambda s: A.cohort_retention(s.fact_sales, 1),
    "regional_leaderboard": lambda s: A.regional_leaderboard(s.fact_sales),
    "state_performance": lambda s: A.state_performance(s.fact_sales, s.dim_customer_key, STATE_REGION, 20),
    "return_rate_by_region": lambda s: A.return_rate_by_region(s.fact_sales),
    # V1-V11 dashboard measures
    "average_order_value": lambda s: V.average_order_value(s.fact_sales),
    "yearly_revenue": lambda s: V.yearly_revenue(s.fact_sales),
    "yearly_revenue_calendar": lambda s: V.yearly_revenue(_without_years(s.fact_sales), calendar=True),
    "monthly_revenue_by_year": lambda s: V.monthly_revenue_by_year(s.fact_sales),
    "seasonality": lambda s: V.seasonality(s.fact_sales),
    "peak_month_by_year": lambda s: V.peak_month_by_year(s.fact_sales),
    "category_revenue": lambda s: V.category_revenue(s.fact_sales, s.dim_product),
    "category_margin_spread": lambda s: V.category_margin_spread(s.fact_sales, s.dim_product),
    "customers_by_order_count": lambda s: V.customers_by_order_count(s.fact_sales),
    "discount_bands": lambda s: V.discount_bands(s.fact_sales),
    "second_purchase_90d": lambda s: V.second_purchase(s.fact_sales, 90),
    "kpi_excluding_returns": lambda s: V.kpi_excluding_returns(s.fact_sales),
    "top_margin_product": lambda s: V.top_margin_product(s.fact_sales, s.dim_product, 1),
}

# Reports over a table loaded without cleaning: its defects are what the
# checks look for, and what fans out the joins with dimensions.
DEFECT_REPORTS = (
    "dq_missing_keys", "dq_duplicate_row_id", "dq_duplicate_lines", "dq_negative_values", "dq_invalid_discount",
    "dq_null_distribution", "dq_summary", "key_checks", "product_performance", "regional_performance",
    "discount_profitability", "monthly_growth", "top_products", "category_contribution", "discount_bands",
    "monthly_revenue_by_year", "second_purchase_90d", "dim_customer_key", "dim_product_key", "quality_report",
    "monthly_growth_calendar", "yearly_revenue_calendar",
)

QUERIES: dict[str, QueryFn] = {key: _star(fn) for key, fn in STAR_REPORTS.items()}
QUERIES |= {f"defects_{key}": _star(STAR_REPORTS[key], defects=True) for key in DEFECT_REPORTS}
QUERIES["dq_orders_vs_returns_extract"] = _orders_vs_returns_extract


def _source_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martlane.plans.warehouse import DRIVER_TABLES
    from martlane.sources.extracts import source_row_counts

    return source_row_counts(spark, {t: f"{sf_dir.rstrip('/')}/{t}.parquet" for t in DRIVER_TABLES})


QUERIES["source_row_counts"] = _source_row_counts


def _published_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six marts published as CSV, read back and counted."""
    from martlane.session import checkpoint_root
    from martlane.sources.sinks import export_all

    out = f"{checkpoint_root(spark)}/martlane-published/{uuid.uuid4().hex}"
    files = export_all(star_for(spark, sf_dir), out)
    return D.table_counts(spark, {f: spark.read.option("header", True).csv(f"{out}/{f}") for f in files})


QUERIES["published_marts"] = _published_marts


def _register_cleaning() -> None:
    from martlane.plans.catalog_keys import CATALOG_QUERIES
    from martlane.plans.clean_keys import CLEAN_QUERIES

    QUERIES.update(CLEAN_QUERIES)
    QUERIES.update(CATALOG_QUERIES)


_register_cleaning()
