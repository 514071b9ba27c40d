"""Load step (S6-S10): staging tables derived from the cleaned orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlane.schemas import PEOPLE_SCHEMA, RETURNS_SCHEMA
from martlane.sources.catalog import replace_table


def load_raw_orders(df: DataFrame, name: str = "raw_orders", as_table: bool = False) -> DataFrame:
    """Create-or-replace the staging view ``raw_orders``, or (``as_table``)
    the catalog table of that name, which outlives the session's views."""
    if as_table:
        return replace_table(df, name)
    df.createOrReplaceTempView(name)
    return df


def derive_returns(raw: DataFrame) -> DataFrame:
    """DISTINCT (order_id, returned) where returned is not NULL; a typed
    empty table when the column is absent (S9)."""
    if "returned" not in raw.columns or "order_id" not in raw.columns:
        return empty_returns(raw.sparkSession)
    return raw.select("order_id", "returned").filter(F.col("returned").isNotNull()).distinct()


def derive_people(raw: DataFrame) -> DataFrame:
    """DISTINCT (region, person) where person is not NULL (S9 if absent)."""
    if "person" not in raw.columns or "region" not in raw.columns:
        return empty_people(raw.sparkSession)
    return raw.select("region", "person").filter(F.col("person").isNotNull()).distinct()


def empty_returns(spark: SparkSession) -> DataFrame:
    """Typed empty placeholder (order_id, returned, region)."""
    cols = ["order_id", "returned", "region"]
    types = {f.name: f.dataType for f in RETURNS_SCHEMA.fields}
    return spark.createDataFrame([], RETURNS_SCHEMA).select(*[F.col(c).cast(types[c]) for c in cols])


def empty_people(spark: SparkSession) -> DataFrame:
    """Typed empty placeholder (region, person)."""
    return spark.createDataFrame([], PEOPLE_SCHEMA).select("region", "person")


def schema_audit(df: DataFrame) -> DataFrame:
    """(name, type, ordinal) of a table's columns - the column list the
    load step branches on.  Built from the plan's schema; no data is read."""
    rows = [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "name string, type string, ordinal int")
