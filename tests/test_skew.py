"""Hot keys: one customer and one order hold a third of all lines.

Results must not depend on how Spark splits the hot partitions: every
skew-sensitive report is computed with AQE skew-join splitting forced on
(broadcast off, tiny thresholds) and with plain planning, and compared."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from martlane.operators import analysis as A
from martlane.operators import clean as C
from martlane.operators import marts as E
from martlane.operators import measures as V
from martlane.operators.star import build_dim_customer
from martlane.plans.warehouse import star_for
from martlane.sources.driver import orders_extract, returns_extract

FORCED_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
PLAIN = {"spark.sql.adaptive.enabled": "false"}


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.fixture(scope="module")
def hot(spark):
    s = star_for(spark, SF_SMALL)
    hot_row = (F.col("row_id") % 3 == 0)
    fact = s.fact_sales.withColumn("customer_id", F.when(hot_row, F.lit("HOT")).otherwise(F.col("customer_id")))
    raw = s.raw_orders.withColumn("customer_id", F.when(hot_row, F.lit("HOT")).otherwise(F.col("customer_id")))
    return fact, build_dim_customer(raw, "distinct")


REPORTS = {
    "customer_loyalty": lambda f, d: E.customer_loyalty(f),
    "regional_performance": lambda f, d: E.regional_performance(f, d),
    "rfm": lambda f, d: A.rfm(f, 50),
    "cohort_retention": lambda f, d: A.cohort_retention(f),
    "repeat_purchase_rate": lambda f, d: A.repeat_purchase_rate(f),
    "second_purchase_90d": lambda f, d: V.second_purchase(f, 90),
}


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_hot_customer_results_stable(spark, hot, name):
    fact, dim = hot
    build = REPORTS[name]
    split = _with_conf(spark, FORCED_SKEW, lambda: sorted(map(tuple, build(fact, dim).collect())))
    plain = _with_conf(spark, PLAIN, lambda: sorted(map(tuple, build(fact, dim).collect())))
    assert split == plain


def test_hot_order_returns_join_is_split(spark):
    orders = orders_extract(spark, SF_SMALL)
    hot_row = (F.col("row_id") % 3 == 0)
    orders = orders.withColumn("order_id", F.when(hot_row, F.lit("0")).otherwise(F.col("order_id")))
    returns = returns_extract(spark, SF_SMALL)

    def run():
        df = C.attach_returns(orders, returns).groupBy("returned").agg(F.count(F.lit(1)).alias("n"))
        rows = sorted(map(tuple, df.collect()), key=str)
        return rows, df._jdf.queryExecution().executedPlan().toString()

    split_rows, plan = _with_conf(spark, FORCED_SKEW, run)
    plain_rows, _ = _with_conf(spark, PLAIN, run)
    assert split_rows == plain_rows
    assert "skew=true" in plan
