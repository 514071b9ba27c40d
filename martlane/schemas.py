"""Schema contracts of the staging tables, dimensions and fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DateType(), T.BooleanType()
MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(4, 2)
DBL = T.DoubleType()
TS = T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Orders extract / raw_orders staging table: the 24 declared columns.
ORDERS_SCHEMA = _struct(
    ("row_id", L), ("order_id", S), ("order_date", D), ("ship_date", D), ("ship_mode", S),
    ("customer_id", S), ("customer_name", S), ("segment", S), ("postal_code", S), ("city", S),
    ("state", S), ("country", S), ("region", S), ("market", S), ("product_id", S),
    ("category", S), ("sub_category", S), ("product_name", S), ("sales", MONEY), ("quantity", I),
    ("discount", RATE), ("profit", MONEY), ("shipping_cost", MONEY), ("order_priority", S),
)
ORDERS_COLUMNS = [f.name for f in ORDERS_SCHEMA.fields]

# Columns the cleaning adds.
CLEAN_EXTRA = _struct(("returned", S), ("person", S), ("profit_margin", DBL))
CLEAN_SCHEMA = T.StructType(ORDERS_SCHEMA.fields + CLEAN_EXTRA.fields)
CLEAN_COLUMNS = [f.name for f in CLEAN_SCHEMA.fields]

RETURNS_SCHEMA = _struct(("returned", S), ("order_id", S), ("region", S))
PEOPLE_SCHEMA = _struct(("person", S), ("region", S))

DIM_DATE_SCHEMA = _struct(
    ("date_key", D), ("order_date", D), ("year_start", D), ("quarter_start", D), ("month_start", D),
    ("year", I), ("quarter", I), ("month", I), ("day", I), ("month_name", S), ("day_of_week", I),
    ("is_weekend", B), ("created_at", TS),
)
DIM_CUSTOMER_KEY_SCHEMA = _struct(
    ("customer_id", S), ("customer_name", S), ("segment", S), ("postal_code", S), ("city", S),
    ("state", S), ("country", S), ("region", S), ("market", S), ("created_at", TS),
)
DIM_CUSTOMER_SCHEMA = _struct(
    ("customer_id", S), ("customer_name", S), ("segment", S), ("country", S), ("region", S),
    ("market", S), ("created_at", TS),
)
DIM_PRODUCT_SCHEMA = _struct(
    ("product_id", S), ("product_name", S), ("category", S), ("sub_category", S), ("created_at", TS),
)
DIM_PEOPLE_SCHEMA = _struct(("region", S), ("person", S), ("created_at", TS))
FACT_SCHEMA = _struct(
    ("sales_id", L), ("row_id", L), ("order_id", S), ("order_date", D), ("ship_date", D),
    ("customer_id", S), ("product_id", S), ("quantity", I), ("sales", MONEY), ("discount", RATE),
    ("profit", MONEY), ("profit_margin", DBL), ("shipping_cost", MONEY), ("order_priority", S),
    ("ship_mode", S), ("returned", B), ("region", S), ("market", S), ("created_at", TS),
)

# Declared keys (the DDL's PRIMARY KEYs, enforced as checks by quality.key_checks).
PRIMARY_KEYS = {
    "dim_date": ["date_key"],
    "dim_customer": ["customer_id"],
    "dim_product": ["product_id"],
    "dim_people": ["region"],
    "fact_sales": ["sales_id"],
}


class SchemaMismatch(ValueError):
    pass


def assert_schema(df: DataFrame, schema: T.StructType, exact_types: bool = True) -> DataFrame:
    """Driver-side contract check on the plan's schema (no job runs)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise SchemaMismatch(f"missing columns: {missing}")
    if exact_types:
        wrong = [(f.name, have[f.name].simpleString(), f.dataType.simpleString())
                 for f in schema.fields if have[f.name] != f.dataType]
        if wrong:
            raise SchemaMismatch(f"wrong types (column, have, want): {wrong}")
    return df


def conform(df: DataFrame, schema: T.StructType, keep_extra: bool = False) -> DataFrame:
    """Select the contract's columns in order, cast to its types; absent ->
    NULL.  ``keep_extra`` appends the frame's other columns as they are."""
    from pyspark.sql import functions as F

    cols, named = set(df.columns), {f.name for f in schema.fields}
    extra = [F.col(f"`{c}`") for c in df.columns if c not in named] if keep_extra else []
    return df.select(*[
        (F.col(f.name) if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ], *extra)
