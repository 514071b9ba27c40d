"""Driver tables -> the three extracts the pipeline expects.

The test data is a TPC-H-like star (lineitem, orders, customer, nation,
region, part, supplier).  This adapter re-shapes it into the reference's
inputs: an Orders extract (one row per order line, 24 columns), a Returns
extract and a People (territory owner) extract.

Scale notes: lineitem and orders are the big sides and meet in a shuffle
join on the order id, the last one, so that the lines come out dealt by order
id; customer and part grow with the data too, so they get no broadcast hint
(AQE broadcasts them at run time only when their measured size is under the
threshold).  No side gets a hint: nation and region are
code tables of 25 and 5 rows, which the planner broadcasts by itself.  Every
line stays: what it refers to is joined from the left.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlane.schemas import ORDERS_COLUMNS, ORDERS_SCHEMA, conform


@dataclass(frozen=True)
class Extracts:
    orders: DataFrame
    returns: DataFrame
    people: DataFrame


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation with its region's name (25 rows)."""
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        "n_nationkey", "n_name", "r_name"
    )


def _customers(customer: DataFrame, geo: DataFrame) -> DataFrame:
    """Customers with their nation and region.  They meet before orders come
    in, so that orders are never dealt by the 25 nations."""
    return customer.join(geo, customer.c_nationkey == geo.n_nationkey, "left")


def orders_extract(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """One row per line item in the Orders-sheet shape (FIXTURES.md §2),
    dealt to ``parts`` partitions by order id, if given."""
    li = read_table(spark, sf_dir, "lineitem")
    # Days and the ship mode's flag take less room in a shuffled row than the
    # time stamps and text they come from.
    li = li.withColumns({"l_shipdate": F.col("l_shipdate").cast("date"), "l_linestatus": F.col("l_linestatus") == "F"})
    o = read_table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    c = read_table(spark, sf_dir, "customer")
    p = read_table(spark, sf_dir, "part")
    geo = _geo(spark, sf_dir)

    price = F.col("l_extendedprice").cast("decimal(12,2)")
    disc = F.col("l_discount").cast("decimal(4,2)")
    sales = F.round(price * (F.lit(1) - disc), 2)
    qty = F.col("l_quantity").cast("int")

    # Join order: customers meet orders at order grain first, so the line
    # grain is shuffled twice (by part key, then by order id) rather than
    # three times, and the wide attributes of an order join last.  Catalyst
    # keeps the written order without CBO statistics.
    order_side = o.join(_customers(c, geo), o.o_custkey == c.c_custkey, "left")
    line_side = li.join(p, li.l_partkey == p.p_partkey, "left")
    line_id, order_id = F.col("l_orderkey").cast("string"), F.col("o_orderkey").cast("string")
    if parts:
        line_side, order_side = line_side.repartition(parts, line_id), order_side.repartition(parts, order_id)
    joined = line_side.join(order_side, line_id == order_id, "left")
    joined_cols = joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("row_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_shipdate").alias("ship_date"),
        F.when(F.col("l_linestatus"), "Standard Class").otherwise("First Class").alias("ship_mode"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.when(F.col("c_custkey") % 10 == 0, F.lit(None).cast("string"))
        .otherwise(F.lpad(F.col("c_custkey").cast("string"), 5, "0"))
        .alias("postal_code"),
        F.col("n_name").alias("city"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("country"),
        F.col("r_name").alias("region"),
        F.col("r_name").alias("market"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.col("p_name").alias("product_name"),
        sales.alias("sales"),
        qty.alias("quantity"),
        disc.alias("discount"),
        (sales - qty * F.col("p_retailprice").cast("decimal(12,2)")).alias("profit"),
        F.round(price * F.col("l_tax").cast("decimal(4,2)"), 2).alias("shipping_cost"),
        F.col("o_orderpriority").alias("order_priority"),
    )
    # Conform to the extract contract (money DECIMAL(18,2), as a real extract
    # is read); ANSI casts raise on overflow rather than corrupt a value.
    return conform(joined_cols, ORDERS_SCHEMA)


def returns_extract(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Returns sheet: status 'P' -> 'Yes', 'F' -> 'No', 'O' -> no row; dealt
    like the orders."""
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    geo = _geo(spark, sf_dir)
    returns = (
        o.filter(F.col("o_orderstatus").isin("P", "F"))
        .join(_customers(c, geo), o.o_custkey == c.c_custkey, "left")
        .select(
            F.when(F.col("o_orderstatus") == "P", "Yes").otherwise("No").alias("returned"),
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("r_name").alias("region"),
        )
    )
    return returns.repartition(parts, "order_id") if parts else returns


def people_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People sheet: per region the lowest supplier name."""
    s = read_table(spark, sf_dir, "supplier")
    geo = _geo(spark, sf_dir)
    return (
        s.join(geo, s.s_nationkey == geo.n_nationkey, "left")
        .groupBy(F.col("r_name").alias("region"))
        .agg(F.min("s_name").alias("person"))
        .select("person", "region")
    )


def driver_extracts(spark: SparkSession, sf_dir: str, parts: int | None = None) -> Extracts:
    return Extracts(
        orders=orders_extract(spark, sf_dir, parts),
        returns=returns_extract(spark, sf_dir, parts),
        people=people_extract(spark, sf_dir),
    )


# The seeded-dirt rules (FIXTURES.md §2), applied to the whole
# extract so the cleaning operators have something to clean.  Every row is
# kept; the row_id residues only decide which rows carry a defect.
NBSP = "\u00a0"


def dirty_orders(orders: DataFrame) -> DataFrame:
    """The Orders extract with deterministic defects on every column the
    cleaning rules touch (serial dates, text money, bad discounts, missing
    keys, padded regions, exact duplicate rows)."""
    rid = F.col("row_id")
    d = orders.select(
        rid,
        F.when(rid % 101 == 0, F.lit(None).cast("string")).otherwise(F.col("order_id")).alias("order_id"),
        F.date_diff(F.col("order_date"), F.lit("1899-12-30").cast("date")).cast("string").alias("order_date"),
        F.col("ship_date").cast("string").alias("ship_date"),
        "ship_mode", "customer_id", "customer_name", "segment", "postal_code", "city", "state", "country",
        F.when(rid % 53 == 0, F.concat(F.lit(NBSP), F.col("region"), F.lit(" "))).otherwise(F.col("region")).alias("region"),
        "market", "product_id", "category", "sub_category", "product_name",
        F.when(rid % 97 == 0, F.lit("N/A")).otherwise(F.col("sales").cast("string")).alias("sales"),
        "quantity",
        F.when(rid % 89 == 0, F.col("discount") + F.lit(2)).otherwise(F.col("discount")).cast("string").alias("discount"),
        F.col("profit").cast("string").alias("profit"),
        F.col("shipping_cost").cast("string").alias("shipping_cost"),
        "order_priority",
    )
    # Exact duplicates in place (rows with row_id % 61 = 0 appear twice):
    # one pass over the extract instead of a union that would compute it twice.
    copies = F.array_repeat(F.lit(0), F.when(rid % 61 == 0, 2).otherwise(1))
    return d.withColumn("_copy", F.explode(copies)).drop("_copy")


# Fixed value: the region whose name a defective People extract misspells.
MISSPELT_REGION = "ASIA"


def dirty_people(people: DataFrame) -> DataFrame:
    """The People extract with one region's name padded, so that its order
    lines find no owner."""
    region = F.col("region")
    return people.withColumn("region", F.when(region == MISSPELT_REGION, F.concat(region, F.lit("."))).otherwise(region))


def defective_orders(orders: DataFrame, returns: DataFrame) -> DataFrame:
    """A staging table as it looks when extracts are loaded without cleaning:
    typed, but with the defects the quality checks look for and attributes
    that vary within a customer and a product.  Every row of the extract is
    there, some twice."""
    rid = F.col("row_id")

    def where(n: int, value, column: str):
        return F.when(rid % n == 0, value).otherwise(F.col(column)).alias(column)

    nothing = F.lit(None)
    changed = {
        "order_id": where(101, nothing, "order_id"), "order_date": where(103, nothing, "order_date"),
        "region": where(29, F.lit("ELSEWHERE"), "region"),
        "product_name": where(31, F.concat("product_name", F.lit(" II")), "product_name"),
        "sales": where(97, nothing, "sales"), "quantity": where(43, -F.col("quantity"), "quantity"),
        "profit": where(107, nothing, "profit"),
        "discount": F.when(rid % 89 == 0, F.col("discount") + 2).when(rid % 13 == 0, nothing).when(
            rid % 7 == 0, F.col("discount") + F.lit(0.3).cast("decimal(4,2)")).otherwise(
            F.col("discount")).cast("decimal(4,2)").alias("discount"),
    }
    flags = returns.groupBy("order_id").agg(F.max("returned").alias("returned"))
    rows = orders.join(flags, "order_id", "left").withColumn(
        "_copy", F.explode(F.array_repeat(F.lit(0), F.when(rid % 61 == 0, 2).otherwise(1))))
    return rows.select(
        F.when((rid % 211 == 0) & (rid % 61 != 0), nothing).otherwise(rid).cast("bigint").alias("row_id"),
        *[changed.get(c, F.col(c)) for c in ORDERS_COLUMNS if c != "row_id"],
        "returned", where(37, nothing, "market").alias("person"),
        (F.col("profit") / F.nullif(F.col("sales"), F.lit(0))).cast("double").alias("profit_margin"))


def supplier_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A People extract with many owners per region (every supplier, in
    supplier-key order as ``_seq``) - input for the first-per-region rule."""
    s = read_table(spark, sf_dir, "supplier")
    geo = _geo(spark, sf_dir)
    return s.join(geo, s.s_nationkey == geo.n_nationkey, "left").select(
        F.col("s_name").alias("person"), F.col("r_name").alias("region"), F.col("s_suppkey").alias("_seq")
    )
