"""Star-schema build (T1-T6): date, customer, product and people dimensions
around a one-row-per-order-line sales fact.

Dimensions come in two grains:

* ``grain="distinct"`` (default): DISTINCT attribute rows, as the reference
  builds them.  When an attribute varies for one key the key appears twice
  and joins fan out (kept on purpose: it is the reference's result).
* ``grain="key"``: one row per key, the attributes of its latest order line
  (ties: lowest row_id) - the declared primary-key grain.

All builds are aggregates (map-side combined), never windows, so a key that
holds a third of all lines costs one partial row per input partition.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.functions.numeric import profit_margin
from martlane.schemas import FACT_SCHEMA

CUSTOMER_DISTINCT_COLS = ["customer_id", "customer_name", "segment", "country", "region", "market"]
CUSTOMER_KEY_COLS = [
    "customer_id", "customer_name", "segment", "postal_code", "city", "state", "country", "region", "market",
]
PRODUCT_COLS = ["product_id", "product_name", "category", "sub_category"]
# The fact's columns in the declared order.
FACT_COLS = [
    "row_id", "order_id", "order_date", "ship_date", "customer_id", "product_id", "quantity", "sales",
    "discount", "profit", "profit_margin", "shipping_cost", "order_priority", "ship_mode",
]


def created_at():
    """Load stamp, one value per statement (foldable, evaluated once)."""
    return F.localtimestamp().alias("created_at")


#: Below every day (an int) and above every row_id (a bigint).
NO_DAY, NO_ROW, DAY = -(1 << 31) - 1, Decimal(10**19), Decimal(10**20)


def versions(raw: DataFrame, cols: list[str]) -> DataFrame:
    """One row per key and attributes: the place ``row_id_by_day`` of its first
    line, which are ordered by latest day, then lowest row_id (NULLs last).
    One number holds both, so lines are hash-aggregated and only the versions
    of a key are shuffled, not its days."""
    day = F.coalesce(F.unix_date("order_date").cast("bigint"), F.lit(NO_DAY)).cast("decimal(10,0)")
    row = F.coalesce(F.col("row_id").cast("decimal(20,0)"), F.lit(NO_ROW))
    place = (row - day * F.lit(DAY)).alias("row_id_by_day")
    return raw.select(*cols, place).groupBy(*cols).agg(F.min("row_id_by_day").alias("row_id_by_day"))


def latest_per_key(found: DataFrame, cols: list[str]) -> DataFrame:
    """One row per key, the first of ``cols``: the attributes of its latest
    order line, ties -> lowest row_id, from the ``versions`` of the lines."""
    key, *attrs = cols
    first = F.min_by(F.struct(*attrs), F.col("row_id_by_day")).alias("_a")
    return found.groupBy(key).agg(first).select(key, *[F.col(f"_a.{c}").alias(c) for c in attrs])


# --------------------------------------------------------------------- T1
def build_dim_date(raw: DataFrame) -> DataFrame:
    """One row per distinct non-NULL order date with calendar attributes.
    day_of_week: 0 = Sunday ... 6 = Saturday; weekend = {0, 6}."""
    d = F.col("order_date")
    dow = (F.dayofweek(d) - 1).cast("int")
    return (
        raw.select("order_date")
        .filter(d.isNotNull())
        .distinct()
        .select(
            d.alias("date_key"),
            d.alias("order_date"),
            F.trunc(d, "year").alias("year_start"),
            F.trunc(d, "quarter").alias("quarter_start"),
            F.trunc(d, "month").alias("month_start"),
            F.year(d).alias("year"),
            F.quarter(d).alias("quarter"),
            F.month(d).alias("month"),
            F.dayofmonth(d).alias("day"),
            F.date_format(d, "MMMM").alias("month_name"),
            dow.alias("day_of_week"),
            dow.isin(0, 6).alias("is_weekend"),
            created_at(),
        )
    )


# --------------------------------------------------------------------- T2
def build_dim_customer(raw: DataFrame, grain: str = "distinct") -> DataFrame:
    if grain == "distinct":
        base = raw.select(*CUSTOMER_DISTINCT_COLS).distinct()
    elif grain == "key":
        base = latest_per_key(versions(raw, CUSTOMER_KEY_COLS), CUSTOMER_KEY_COLS)
    else:
        raise ValueError(f"unknown grain {grain!r}")
    return base.select("*", created_at())


# --------------------------------------------------------------------- T3
def build_dim_product(raw: DataFrame, grain: str = "distinct") -> DataFrame:
    if grain == "distinct":
        base = raw.select(*PRODUCT_COLS).distinct()
    elif grain == "key":
        base = latest_per_key(versions(raw, PRODUCT_COLS), PRODUCT_COLS)
    else:
        raise ValueError(f"unknown grain {grain!r}")
    return base.select("*", created_at())


# --------------------------------------------------------------------- T4
def dim_people_of(raw_people: DataFrame) -> DataFrame:
    """T4 from the staging table, which holds the same distinct rows."""
    return raw_people.select("region", "person", created_at())


def build_dim_people(raw: DataFrame) -> DataFrame:
    from martlane.operators.load import derive_people

    return dim_people_of(derive_people(raw))


# --------------------------------------------------------------------- T5
def build_fact_sales(raw: DataFrame, with_sales_id: bool = True) -> DataFrame:
    """T5: narrow projection of the cleaned lines (no shuffle).

    ``returned`` becomes boolean (default false); region and market are kept
    on the fact (the analyses group by them).  ``sales_id`` of this lazy form
    is only unique (``monotonically_increasing_id``); the written warehouse
    numbers the fact 1..n in row-key order (``operators.numbering``).
    """
    cols = [F.col(c) for c in FACT_COLS]
    returned = F.coalesce(F.col("returned") == F.lit("Yes"), F.lit(False)).alias("returned")
    sid = [F.monotonically_increasing_id().alias("sales_id")] if with_sales_id else []
    return raw.select(*sid, *cols, returned, F.col("region"), F.col("market"), created_at())


#: Columns that a line is dealt with in one number, and its bits: by what rule
#: its margin is found (0: it is kept as it is), then NULL as 0 in the others.
DEALT = ("profit_margin", "returned", "discount", "quantity")
_RETURNED, _DISCOUNT, _QUANTITY = 2, 4, 19
_NO_CENTS, _NO_INT = 10_000, (1 << 31) + 1


def _margins():
    """The cleaning's margin (C18), and the ratio it rounds."""
    ratio = (F.col("profit") / F.nullif(F.col("sales"), F.lit(0))).cast("double")
    return profit_margin("profit", "sales"), ratio


def narrow_fact(fact: DataFrame) -> DataFrame:
    """``fact`` with fewer bytes a line, to be dealt and made ``wide_fact``
    again: every value of ``DEALT`` comes back as it was."""
    if any(fact.schema[c].dataType != FACT_SCHEMA[c].dataType for c in DEALT):
        return fact
    margin, ratio = (F.col("profit_margin").eqNullSafe(m) for m in _margins())
    rule = F.when(margin, 1).when(ratio, 2).otherwise(0).cast("bigint")
    returned = F.when(F.col("returned"), 2).when(~F.col("returned"), 1).otherwise(0).cast("bigint")
    cents = F.coalesce((F.col("discount") * 100).cast("bigint") + _NO_CENTS, F.lit(0).cast("bigint"))
    whole = F.coalesce(F.col("quantity").cast("bigint") + _NO_INT, F.lit(0).cast("bigint"))
    bits = rule + F.shiftleft(returned, _RETURNED) + F.shiftleft(cents, _DISCOUNT) + F.shiftleft(whole, _QUANTITY)
    kept = F.when(~margin & ~ratio, F.col("profit_margin"))
    return fact.withColumns({"_bits": bits, "profit_margin": kept}).drop(*DEALT[1:])


def wide_fact(narrow: DataFrame) -> DataFrame:
    """What ``narrow_fact`` was given, its columns in another order."""
    if "_bits" not in narrow.columns:
        return narrow

    def field(low: int, high: int):
        return F.shiftright("_bits", low).bitwiseAND(F.lit((1 << (high - low)) - 1))

    rule, cents, whole = field(0, _RETURNED), field(_DISCOUNT, _QUANTITY), F.shiftright("_bits", _QUANTITY)
    margin, ratio = _margins()
    return narrow.withColumns({
        "profit_margin": F.when(rule == 1, margin).when(rule == 2, ratio).otherwise(F.col("profit_margin")),
        "returned": F.nullif(field(_RETURNED, _DISCOUNT), F.lit(0)) == 2,
        "discount": ((F.nullif(cents, F.lit(0)) - _NO_CENTS).cast("decimal(6,0)") / 100).cast(FACT_SCHEMA["discount"].dataType),
        "quantity": (F.nullif(whole, F.lit(0)) - _NO_INT).cast("int"),
    }).drop("_bits")


@dataclass
class Star:
    """Cleaned staging tables plus the star schema."""

    raw_orders: DataFrame
    raw_returns: DataFrame
    raw_people: DataFrame
    dim_date: DataFrame
    dim_customer: DataFrame
    dim_customer_key: DataFrame
    dim_product: DataFrame
    dim_product_key: DataFrame
    dim_people: DataFrame
    fact_sales: DataFrame
    root: str | None = None  # the folder of a written warehouse

    def tables(self) -> dict[str, DataFrame]:
        return {name: df for name, df in self.__dict__.items() if name != "root"}


def build_star(raw: DataFrame) -> Star:
    """T1-T5 from a cleaned ``raw_orders`` frame (lazy; see plans.warehouse
    for the materialised version)."""
    from martlane.operators.load import derive_people, derive_returns

    return Star(
        raw_orders=raw,
        raw_returns=derive_returns(raw),
        raw_people=derive_people(raw),
        dim_date=build_dim_date(raw),
        dim_customer=build_dim_customer(raw, "distinct"),
        dim_customer_key=build_dim_customer(raw, "key"),
        dim_product=build_dim_product(raw, "distinct"),
        dim_product_key=build_dim_product(raw, "key"),
        dim_people=build_dim_people(raw),
        fact_sales=build_fact_sales(raw),
    )
