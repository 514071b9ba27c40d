"""Shared aggregate expressions for marts and analyses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlane.functions.numeric import margin, pct


def money_sum(c: str) -> Column:
    """Exact DECIMAL sum (cast it to double at the report boundary)."""
    return F.sum(F.col(c))


def n_distinct(c: str) -> Column:
    return F.count_distinct(F.col(c))


def month_of(c: str = "order_date") -> Column:
    return F.trunc(F.col(c), "MM")


def per_product(fact: DataFrame, with_discount: bool = False) -> DataFrame:
    """Pre-aggregate the fact to one row per product before it meets the
    product dimension: the join then moves one partial row per product and
    partition instead of every line, and a hot product collapses map-side.
    Sums are exact (DECIMAL / BIGINT), so re-summing after the join - once
    per matching dimension row, which keeps the distinct-grain fan-out - is
    identical to joining the lines."""
    aggs = [
        F.sum("sales").alias("p_sales"),
        F.sum("profit").alias("p_profit"),
        F.sum(F.col("quantity").cast("bigint")).alias("p_quantity"),
    ]
    if with_discount:
        aggs += [F.sum("discount").cast("decimal(18,2)").alias("p_discount_sum"),
                 F.count("discount").alias("p_discount_n")]
    return fact.groupBy("product_id").agg(*aggs)


def fact_without_dim_attrs(fact: DataFrame, *attrs: str) -> DataFrame:
    """Drop fact columns a USING-join would otherwise take from the dimension."""
    return fact.drop(*[a for a in attrs if a in fact.columns])


def on_calendar(periods: DataFrame, period: str, step: str, measures: tuple[str, ...]) -> DataFrame:
    """``periods`` (one row a period, dates or whole numbers ``step`` apart)
    with a row for every period between the first and the last; the
    ``measures`` of added rows are zero.  Each row adds the periods up to the
    next one, so ``periods`` is computed once.  A NULL period keeps its row.
    Sized by the calendar: the window sees a row a period."""
    w = Window.orderBy(F.col(period).asc_nulls_last())
    gap = F.when(F.col("_next").isNull(), F.array(period)).otherwise(
        F.expr(f"sequence({period}, _next - {step}, {step})"))
    own = F.col("_at").eqNullSafe(F.col(period))
    return (
        periods.withColumn("_next", F.lead(period).over(w))
        .select("*", F.explode(gap).alias("_at"))
        .select(F.col("_at").alias(period),
                *[F.when(own, F.col(c)).otherwise(F.lit(0).cast(periods.schema[c].dataType)).alias(c)
                  for c in measures])
    )


__all__ = ["money_sum", "n_distinct", "month_of", "on_calendar", "margin", "pct", "fact_without_dim_attrs", "per_product"]
