"""Query keys over catalog tables (S6, S18): the warehouse is published to a
database of its own and read back by name, as a SQL user would."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from martlane.operators.load import load_raw_orders
from martlane.operators.quality import table_counts
from martlane.plans.warehouse import TABLES, publish, star_for
from martlane.session import checkpoint_root
from martlane.sources.catalog import create_database, create_table, replace_table, table_or_none


def _database(spark: SparkSession, sf_dir: str) -> str:
    """A fresh database in the shared folder with the warehouse's tables."""
    name = f"martlane_{uuid.uuid4().hex}"
    create_database(spark, name, f"{checkpoint_root(spark)}/martlane-catalog/{name}")
    publish(spark, star_for(spark, sf_dir, whole=True).root, name)
    return name


def catalog_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table the catalog has, NULL for a dropped one."""
    db = _database(spark, sf_dir)
    create_table(spark.table(f"{db}.dim_people"), f"{db}.dim_retired")
    spark.sql(f"DROP TABLE {db}.dim_retired")
    return table_counts(spark, {t: table_or_none(spark, f"{db}.{t}") for t in (*TABLES, "dim_retired")})


def catalog_raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_orders`` created as a table, then replaced by what it holds
    itself, and read through the catalog."""
    from martlane.plans.registry import comparable

    db = f"martlane_{uuid.uuid4().hex}"
    create_database(spark, db, f"{checkpoint_root(spark)}/martlane-catalog/{db}")
    loaded = load_raw_orders(star_for(spark, sf_dir).raw_orders, f"{db}.raw_orders", as_table=True)
    return comparable(replace_table(loaded, f"{db}.raw_orders"))


def catalog_segment_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over the published star."""
    db = _database(spark, sf_dir)
    return spark.sql(f"""
        SELECT c.segment, COUNT(*) AS lines, CAST(SUM(f.sales) AS DOUBLE) AS revenue
        FROM {db}.fact_sales f JOIN {db}.dim_customer_key c ON f.customer_id = c.customer_id
        GROUP BY c.segment""")


CATALOG_QUERIES = {
    "catalog_counts": catalog_counts,
    "catalog_raw_orders": catalog_raw_orders,
    "catalog_segment_sales": catalog_segment_sales,
}
