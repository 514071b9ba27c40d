"""Hand fixtures: one test per semantic trap the driver data cannot show."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from helpers import clean_df, orders_df
from martlane.functions.dates import coerce_date
from martlane.functions.numeric import null_out_of_range, profit_margin, round_half_away, to_money
from martlane.functions.text import fill_postal, normalize_flag
from martlane.operators import analysis as A
from martlane.operators import clean as C
from martlane.operators import marts as E
from martlane.operators.load import derive_people, derive_returns, schema_audit
from martlane.operators.star import build_dim_customer, build_fact_sales

NBSP = "\u00a0"


def col_values(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_returns_duplicate(spark):
    orders = orders_df(spark, [{"order_id": "O1"}])
    returns = spark.createDataFrame([("Yes", "O1", "R1"), ("yes", "O1", "R1")], "returned string, order_id string, region string")
    assert C.attach_returns(orders, returns).count() == 2
    assert C.attach_returns(orders, returns, dedupe=True).count() == 1


def test_flag_values(spark):
    vals = ["yes ", "NO", "maybe", None, "Y", NBSP + "Yes"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(normalize_flag("v")).collect()]
    assert got == ["Yes", "No", "No", "No", "No", "Yes"]


def test_region_split(spark):
    rows = [("Canada", "Ontario", "X"), ("Canada", "Alberta", "X"), ("Canada", None, "X"), ("Other", "Ontario", "X")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, country string, state string, region string")
    got = col_values(C.split_region(df).orderBy("i"), "region")
    assert got == ["Eastern Canada", "Western Canada", "Western Canada", "X"]


def test_people_first(spark):
    people = spark.createDataFrame([("Bob", "R1", 2), ("Al", "R1", 1), ("Cy", "R2", 5)], "person string, region string, _seq long")
    got = {r.region: r.person for r in C.dedupe_people(people).collect()}
    assert got == {"R1": "Al", "R2": "Cy"}


def test_null_region_people(spark):
    orders = orders_df(spark, [{"region": None}])
    people = spark.createDataFrame([("Nobody", None)], "person string, region string")
    assert col_values(C.attach_people(orders, people), "person") == ["Nobody"]


def test_customer_two_regions(spark):
    raw = clean_df(spark, [
        {"row_id": 1, "customer_id": "C1", "region": "R1", "market": "M", "sales": Decimal("10.00"),
         "order_date": dt.date(2014, 1, 1)},
        {"row_id": 2, "customer_id": "C1", "region": "R2", "market": "M", "sales": Decimal("0.00"),
         "order_date": dt.date(2014, 2, 1)},
    ])
    fact = build_fact_sales(raw)
    e5 = {r.region: r.revenue for r in E.regional_performance(fact, build_dim_customer(raw, "distinct")).collect()}
    assert e5 == {"R1": 10.0, "R2": 10.0}
    keyed = E.regional_performance(fact, build_dim_customer(raw, "key")).collect()
    assert [(r.region, r.revenue) for r in keyed] == [("R2", 10.0)]


def test_dates(spark):
    vals = ["42000", "42000.5", "2014-01-02", "x", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(coerce_date("v", df.schema["v"].dataType)).collect()]
    assert got == [dt.datetime(2014, 12, 27), dt.datetime(2014, 12, 27, 12), dt.datetime(2014, 1, 2), None, None]


def test_dates_keep_typed(spark):
    df = spark.createDataFrame([(dt.date(2014, 1, 2),)], "d date")
    assert df.select(coerce_date("d", df.schema["d"].dataType)).first()[0] == dt.datetime(2014, 1, 2)


def test_postal(spark):
    df = spark.createDataFrame([(0, "01234"), (1, " "), (2, None)], "i int, p string")
    assert [r[0] for r in df.orderBy("i").select(fill_postal("p")).collect()] == ["01234", "Unknown", "Unknown"]


def test_money(spark):
    df = spark.createDataFrame([(0, "12.345"), (1, "N/A"), (2, None)], "i int, m string")
    up = [r[0] for r in df.orderBy("i").select(to_money("m")).collect()]
    even = [r[0] for r in df.orderBy("i").select(to_money("m", half_even=True)).collect()]
    assert up == [Decimal("12.35"), None, None]
    assert even == [Decimal("12.34"), None, None]


def test_margin(spark):
    df = spark.createDataFrame([(0, 1.0, 0.0), (1, 1.0, None), (2, 1.0, 3.0)], "i int, p double, s double")
    assert [r[0] for r in df.orderBy("i").select(profit_margin("p", "s")).collect()] == [None, None, 0.3333]


def test_round_half_away_matches_binary(spark):
    df = spark.createDataFrame([(0, 1.005), (1, 0.125), (2, -0.0001), (3, 2.5)], "i int, x double")
    got = [r[0] for r in df.orderBy("i").select(round_half_away("x", 2)).collect()]
    assert got == [1.0, 0.13, 0.0, 2.5]
    assert str(got[2]) == "0.0"  # no negative zero


def test_discount_range(spark):
    vals = [Decimal("-0.10"), Decimal("0.00"), Decimal("1.00"), Decimal("1.01"), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, d decimal(4,2)")
    got = [r[0] for r in df.orderBy("i").select(null_out_of_range("d")).collect()]
    assert got == [None, Decimal("0.00"), Decimal("1.00"), None, None]


def _months(n, skip=None):
    out, d = [], dt.date(2014, 1, 1)
    for i in range(n + (1 if skip is not None else 0)):
        m = dt.date(d.year + (d.month - 1 + i) // 12, (d.month - 1 + i) % 12 + 1, 1)
        if skip is not None and i == skip:
            continue
        out.append(m)
    return out


def test_month_gap(spark):
    months = _months(13, skip=5)  # 13 months present, one calendar month missing
    raw = clean_df(spark, [{"row_id": i, "order_id": f"O{i}", "order_date": m, "sales": Decimal(i + 1)}
                           for i, m in enumerate(months)])
    rows = A.monthly_growth(build_fact_sales(raw)).collect()
    assert len(rows) == 13
    last = rows[-1]
    # LAG(12) is positional: the 13th row compares with the 1st row, 13 calendar months earlier
    assert last.revenue_last_year == 1.0 and last.yoy_pct == 1200.0


def test_null_month(spark):
    raw = clean_df(spark, [
        {"row_id": 1, "order_id": "A", "order_date": dt.date(2014, 1, 5), "sales": Decimal("10.00")},
        {"row_id": 2, "order_id": "B", "order_date": dt.date(2014, 2, 5), "sales": Decimal("20.00")},
        {"row_id": 3, "order_id": "C", "order_date": None, "sales": Decimal("5.00")},
    ])
    rows = A.monthly_growth(build_fact_sales(raw)).collect()
    assert rows[-1].month is None
    assert rows[1].prev_month_revenue == 10.0 and rows[1].mom_pct == 100.0


def test_null_customer_cohort(spark):
    raw = clean_df(spark, [
        {"row_id": 1, "customer_id": None, "order_date": dt.date(2014, 3, 1)},
        {"row_id": 2, "customer_id": "C1", "order_date": dt.date(2014, 1, 1)},
        {"row_id": 3, "customer_id": "C1", "order_id": "O2", "order_date": dt.date(2014, 2, 1)},
    ])
    rows = {r.cohort_month: r for r in A.cohort_retention(build_fact_sales(raw)).collect()}
    assert rows[dt.date(2014, 3, 1)].cohort_size == 0
    assert rows[dt.date(2014, 3, 1)].retention_next_month_pct is None
    assert rows[dt.date(2014, 1, 1)].retained_next_month == 1


def test_zero_revenue(spark):
    raw = clean_df(spark, [
        {"row_id": 1, "order_id": "A", "order_date": dt.date(2014, 1, 5), "sales": Decimal("0.00")},
        {"row_id": 2, "order_id": "B", "order_date": dt.date(2014, 2, 5), "sales": Decimal("20.00")},
    ])
    rows = A.monthly_growth(build_fact_sales(raw)).collect()
    assert rows[1].prev_month_revenue == 0.0 and rows[1].mom_pct is None


def test_missing_columns(spark):
    orders = orders_df(spark, [{}]).drop("region")
    assert derive_returns(orders).count() == 0
    assert derive_returns(orders).columns == ["order_id", "returned", "region"]
    assert derive_people(orders).columns == ["region", "person"]
    people = spark.createDataFrame([("P",)], "person string")
    assert col_values(C.attach_people(orders, people), "person") == ["Unknown"]


def test_bad_returns(spark):
    orders = orders_df(spark, [{}])
    returns = spark.createDataFrame([("Yes",)], "returned string")
    with pytest.raises(ValueError):
        C.attach_returns(orders, returns)


def test_headers(spark):
    df = spark.createDataFrame([(1,)], "` Sub-Category ` int")
    assert C.normalize_columns(df).columns == ["sub_category"]


def test_exact_duplicates_and_counters(spark):
    orders = orders_df(spark, [{"row_id": 1}, {"row_id": 1}, {"row_id": 2, "quantity": -1},
                               {"row_id": 3, "order_id": None}])
    returns = spark.createDataFrame([("Yes", "O1", "R1")], "returned string, order_id string, region string")
    people = spark.createDataFrame([("Pat", "R1")], "person string, region string")
    rep = C.CleanReport()
    out = C.clean_orders(orders, returns, people, report=rep)
    assert out.count() == 2  # duplicate dropped, missing key dropped
    got = rep.get()
    assert got["input.rows"] == 4 and got["deduped.rows"] == 3
    assert got["deduped.negative_quantity"] == 1 and got["deduped.missing_order_id"] == 1


def test_region_whitespace_order(spark):
    orders = orders_df(spark, [{"region": NBSP + "R1 "}])
    returns = spark.createDataFrame([], "returned string, order_id string, region string")
    people = spark.createDataFrame([("Pat", "R1")], "person string, region string")
    late = C.clean_orders(orders, returns, people).first()
    early = C.clean_orders(orders, returns, people, normalize_first=True).first()
    assert (late.region, late.person) == ("R1", "Unknown")
    assert (early.region, early.person) == ("R1", "Pat")


def test_clean_is_idempotent(spark):
    orders = orders_df(spark, [{"row_id": i, "order_id": f"O{i}", "sales": f"{i}.005", "region": " R1"}
                               for i in range(5)], text_cols=("sales",))
    returns = spark.createDataFrame([("yes", "O1", "R1")], "returned string, order_id string, region string")
    people = spark.createDataFrame([("Pat", "R1")], "person string, region string")
    once = C.clean_orders(orders, returns, people)
    twice = C.clean_orders(once.drop("returned", "person", "profit_margin"), once.select("returned", "order_id").distinct(), people)
    cols = [c for c in once.columns if c != "person"]
    assert sorted(once.select(cols).collect()) == sorted(twice.select(cols).collect())


def test_schema_audit(spark):
    df = orders_df(spark, [{}])
    rows = schema_audit(df).collect()
    assert rows[0].name == "row_id" and rows[0].ordinal == 0 and len(rows) == 24


def test_product_fan_out_survives_pre_aggregation(spark):
    from martlane.operators.star import build_dim_product

    raw = clean_df(spark, [
        {"row_id": 1, "product_id": "P1", "product_name": "A", "sales": Decimal("10.00"), "discount": Decimal("0.10")},
        {"row_id": 2, "product_id": "P1", "product_name": "B", "sales": Decimal("5.00"), "discount": Decimal("0.20")},
    ])
    fact, dim = build_fact_sales(raw), build_dim_product(raw, "distinct")
    e3 = sorted((r.product_name, r.revenue) for r in E.product_performance(fact, dim).collect())
    assert e3 == [("A", 15.0), ("B", 15.0)]
    a3 = sorted((r.product_name, r.total_revenue, r.avg_discount) for r in A.top_products(fact, dim).collect())
    assert a3 == [("A", 15.0, 0.15), ("B", 15.0, 0.15)]
    assert A.category_contribution(fact, dim).first().cat_sales == 30.0
    keyed = E.product_performance(fact, build_dim_product(raw, "key")).collect()
    # same order date on both lines: the tie goes to the lowest row_id
    assert [(r.product_name, r.revenue) for r in keyed] == [("A", 15.0)]
