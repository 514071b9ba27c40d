"""Built tables honour their declared contracts."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
from martlane import schemas as S
from martlane.plans.warehouse import star_for


@pytest.fixture(scope="module")
def star(spark):
    return star_for(spark, SF_SMALL)


@pytest.mark.parametrize("table,schema", [
    ("raw_orders", S.CLEAN_SCHEMA),
    ("dim_date", S.DIM_DATE_SCHEMA),
    ("dim_customer", S.DIM_CUSTOMER_SCHEMA),
    ("dim_customer_key", S.DIM_CUSTOMER_KEY_SCHEMA),
    ("dim_product", S.DIM_PRODUCT_SCHEMA),
    ("dim_product_key", S.DIM_PRODUCT_SCHEMA),
    ("dim_people", S.DIM_PEOPLE_SCHEMA),
    ("fact_sales", S.FACT_SCHEMA),
])
def test_contract(star, table, schema):
    df = getattr(star, table)
    S.assert_schema(df, schema)
    extra = set(df.columns) - {f.name for f in schema.fields}
    assert not extra, extra


def test_contract_violation_is_reported(spark):
    df = spark.createDataFrame([(1,)], "row_id int")
    with pytest.raises(S.SchemaMismatch):
        S.assert_schema(df, S.ORDERS_SCHEMA)
    with pytest.raises(S.SchemaMismatch):
        S.assert_schema(df, S.ORDERS_SCHEMA.__class__([S.ORDERS_SCHEMA["row_id"]]))
