"""Data-quality checks D1-D12, key checks K1 and table counts S18.

The per-table counters (D1, D2, D5, D6, D11) are conditional counts that
Catalyst folds into a single aggregate pass when taken from ``quality_scan``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlane.operators.common import money_sum


def _one():
    return F.lit(1)


def quality_scan(raw: DataFrame) -> DataFrame:
    """D1(orders), D2, D5, D6, D11 in one pass over raw_orders (one row)."""
    c = F.col
    return raw.agg(
        F.count(_one()).alias("orders_raw_count"),
        F.count_if(c("order_id").isNull()).alias("missing_order_id"),
        F.count_if(c("row_id").isNull()).alias("missing_row_id"),
        F.count_if(c("quantity") < 0).alias("negative_quantity"),
        F.count_if(c("sales") < 0).alias("negative_sales"),
        F.count_if(c("profit") < 0).alias("negative_profit"),
        F.count_if(c("discount").isNotNull() & ((c("discount") < 0) | (c("discount") > 1))).alias("invalid_discount"),
        F.count_if(c("sales").isNull()).alias("sales_nulls"),
        F.count_if(c("quantity").isNull()).alias("quantity_nulls"),
        F.count_if(c("profit").isNull()).alias("profit_nulls"),
    )


def row_counts(raw: DataFrame, returns: DataFrame, people: DataFrame) -> DataFrame:
    """(check, cnt) for the three staging tables."""
    def one(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(_one()).alias("cnt")).select(F.lit(name).alias("check"), "cnt")

    return one(raw, "orders_raw_count").unionByName(one(returns, "returns_raw_count")).unionByName(
        one(people, "people_raw_count"))


def missing_keys(raw: DataFrame) -> DataFrame:
    """missing_order_id, missing_row_id."""
    return quality_scan(raw).select("missing_order_id", "missing_row_id")


def duplicate_row_id(raw: DataFrame, n: int = 50) -> DataFrame:
    """D3: row_ids seen more than once, most repeated first (ties: row_id)."""
    return (
        raw.groupBy("row_id").agg(F.count(_one()).alias("cnt"))
        .filter(F.col("cnt") > 1)
        .orderBy(F.col("cnt").desc(), F.col("row_id").asc_nulls_last())
        .limit(n)
    )


def duplicate_lines(raw: DataFrame, n: int = 50) -> DataFrame:
    """(order_id, product_id) seen more than once (ties: the key)."""
    return (
        raw.groupBy("order_id", "product_id").agg(F.count(_one()).alias("cnt"))
        .filter(F.col("cnt") > 1)
        .orderBy(F.col("cnt").desc(), F.col("order_id").asc_nulls_last(), F.col("product_id").asc_nulls_last())
        .limit(n)
    )


def negative_values(raw: DataFrame) -> DataFrame:
    """negative_quantity, negative_sales, negative_profit."""
    return quality_scan(raw).select("negative_quantity", "negative_sales", "negative_profit")


def invalid_discount(raw: DataFrame) -> DataFrame:
    """Non-NULL discounts outside [0, 1]."""
    return quality_scan(raw).select("invalid_discount")


def category_distribution(raw: DataFrame, n: int = 10) -> DataFrame:
    """Category, cnt, total_sales, total_profit; top-n by sales (ties: category)."""
    return (
        raw.groupBy("category")
        .agg(F.count(_one()).alias("cnt"), money_sum("sales").alias("_s"), money_sum("profit").alias("_p"))
        .select("category", "cnt", F.col("_s").cast("double").alias("total_sales"),
                F.col("_p").cast("double").alias("total_profit"))
        .orderBy(F.col("total_sales").desc_nulls_last(), F.col("category").asc_nulls_last())
        .limit(n)
    )


def market_distribution(raw: DataFrame) -> DataFrame:
    """Market, cnt, total_sales (sales descending, ties: market)."""
    return (
        raw.groupBy("market")
        .agg(F.count(_one()).alias("cnt"), money_sum("sales").cast("double").alias("total_sales"))
        .orderBy(F.col("total_sales").desc_nulls_last(), F.col("market").asc_nulls_last())
    )


def returned_values(returns: DataFrame) -> DataFrame:
    """Returned, cnt over raw_returns."""
    return returns.groupBy("returned").agg(F.count(_one()).alias("cnt"))


def orders_vs_returns(raw: DataFrame, returns: DataFrame) -> DataFrame:
    """distinct_orders vs distinct_returns (two 1-row aggregates)."""
    a = raw.agg(F.count_distinct("order_id").alias("distinct_orders"))
    b = returns.agg(F.count_distinct("order_id").alias("distinct_returns"))
    return a.crossJoin(b)


def null_distribution(raw: DataFrame) -> DataFrame:
    """sales_nulls, quantity_nulls, profit_nulls."""
    return quality_scan(raw).select("sales_nulls", "quantity_nulls", "profit_nulls")


def summary(raw: DataFrame) -> DataFrame:
    """The loader's smoke figures as (check, value) rows (unpivoted)."""
    dup = (
        raw.groupBy("row_id").agg(F.count(_one()).alias("cnt")).filter(F.col("cnt") > 1)
        .agg(F.count(_one()).alias("duplicate_row_id"))
    )
    wide = quality_scan(raw).select("orders_raw_count", "missing_order_id", "invalid_discount",
                                    "negative_quantity").crossJoin(dup)
    return wide.select(F.expr(
        "stack(5, 'orders_raw_count', orders_raw_count, 'missing_order_id', missing_order_id, "
        "'invalid_discount', invalid_discount, 'negative_quantity', negative_quantity, "
        "'duplicate_row_id', duplicate_row_id) AS (check, value)"
    ))


# Which check a figure of ``quality_scan`` belongs to.
SCAN_FIGURES = {
    "row_counts": ("orders_raw_count",),
    "missing_keys": ("missing_order_id", "missing_row_id"),
    "negative_values": ("negative_quantity", "negative_sales", "negative_profit"),
    "invalid_discount": ("invalid_discount",),
    "null_distribution": ("sales_nulls", "quantity_nulls", "profit_nulls"),
}


def quality_report(raw: DataFrame, returns: DataFrame, people: DataFrame) -> DataFrame:
    """D1, D2, D5, D6 and D11 together as (check, figure, value) rows, from
    one read of ``raw`` (and one each of the two small staging tables)."""
    rows = F.array(*[F.struct(F.lit(check).alias("check"), F.lit(figure).alias("figure"), F.col(figure).alias("value"))
                     for check, figures in SCAN_FIGURES.items() for figure in figures])
    out = quality_scan(raw).select(F.inline(rows))
    for df, figure in ((returns, "returns_raw_count"), (people, "people_raw_count")):
        out = out.unionByName(df.agg(F.count(_one()).alias("value")).select(
            F.lit("row_counts").alias("check"), F.lit(figure).alias("figure"), "value"))
    return out


def key_checks(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """K1: declared primary keys as checks -> (table_name, dup_keys, null_keys).

    dup_keys = number of key values held by more than one row; null_keys =
    rows whose key has a NULL part.  One aggregate per table (map-side
    combined), results unioned."""
    parts = []
    for name, (df, key) in tables.items():
        null_cond = F.lit(False)
        for k in key:
            null_cond = null_cond | F.col(k).isNull()
        per_key = df.groupBy(*key).agg(F.count(_one()).alias("_n"), F.max(null_cond.cast("int")).alias("_null"))
        parts.append(per_key.agg(
            F.count_if((F.col("_n") > 1) & (F.col("_null") == 0)).alias("dup_keys"),
            F.coalesce(F.sum(F.when(F.col("_null") == 1, F.col("_n"))), F.lit(0)).cast("bigint").alias("null_keys"),
        ).select(F.lit(name).alias("table_name"), "dup_keys", "null_keys"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_counts(spark: SparkSession, tables: dict[str, DataFrame | None]) -> DataFrame:
    """(table_name, rows); NULL rows when a table is missing."""
    parts = []
    for name, df in tables.items():
        if df is None:
            parts.append(spark.range(1).select(F.lit(name).alias("table_name"), F.lit(None).cast("bigint").alias("rows")))
        else:
            parts.append(df.agg(F.count(_one()).alias("rows")).select(F.lit(name).alias("table_name"), "rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

