"""Catalog tables, marts from shared roll-ups, one-scan report, calendar rows."""

from __future__ import annotations

import datetime as dt
import os
import uuid
from decimal import Decimal

import pytest
from conftest import SF_SMALL
from helpers import clean_df
from martlane.operators import analysis as A
from martlane.operators import marts as E
from martlane.operators import measures as V
from martlane.operators import quality as D
from martlane.operators.load import load_raw_orders
from martlane.operators.star import build_star
from martlane.plans.warehouse import TABLES, build_from_clean, publish, star_for
from martlane.sources import catalog as C
from martlane.sources import sinks as K
from pyspark.sql import functions as F


@pytest.fixture()
def db(spark, scratch):
    name = f"t_{uuid.uuid4().hex}"
    C.create_database(spark, name, f"{scratch}/{name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def ids(df):
    return sorted(r[0] for r in df.collect())


def failing(spark):
    return spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("broken row"))).otherwise(F.col("id")).alias("id"))


def test_a_failed_replace_leaves_the_old_table(spark, db, scratch):
    C.replace_table(spark.range(3), f"{db}.t")
    with pytest.raises(Exception, match="broken row"):
        C.replace_table(failing(spark), f"{db}.t")
    assert ids(spark.table(f"{db}.t")) == [0, 1, 2]
    assert len(os.listdir(f"{scratch}/{db}/t")) == 1  # what the failed write left is gone
    with pytest.raises(Exception, match="broken row"):
        C.replace_table(failing(spark), f"{db}.never")
    assert C.table_or_none(spark, f"{db}.never") is None


def test_replace_may_read_its_table_and_keeps_one_version(spark, db, scratch):
    C.replace_table(spark.range(2), f"{db}.t")
    for _ in range(4):
        before = spark.table(f"{db}.t")
        C.replace_table(before.union(before.select(F.col("id") + 100)), f"{db}.t")
    assert spark.table(f"{db}.t").count() == 32 and before.count() == 16
    assert len(os.listdir(f"{scratch}/{db}/t")) == 2


def test_replace_with_other_columns_and_partitions(spark, db):
    C.replace_table(spark.range(2), f"{db}.t")
    C.replace_table(spark.range(4).select("id", (F.col("id") % 2).cast("int").alias("part")), f"{db}.t", "part")
    assert ids(spark.sql(f"SELECT id FROM {db}.t WHERE part = 1")) == [1, 3]
    C.replace_table(spark.range(6).select("id", (F.col("id") % 3).cast("int").alias("part")), f"{db}.t", "part")
    assert ids(spark.sql(f"SELECT id FROM {db}.t WHERE part = 2")) == [2, 5]
    C.replace_table(spark.range(0).select(F.lit("x").alias("only")), f"{db}.t")
    assert spark.table(f"{db}.t").columns == ["only"] and spark.table(f"{db}.t").count() == 0
    assert {t.name for t in spark.catalog.listTables(db)} == {"t"}


def test_create_if_absent_does_not_run_its_query(spark, db):
    K.save_table(spark.range(3), f"{db}.t", replace=False)
    K.save_table(failing(spark), f"{db}.t", replace=False)
    assert ids(spark.table(f"{db}.t")) == [0, 1, 2]


def test_bare_names_belong_to_the_current_database(spark, db):
    spark.catalog.setCurrentDatabase(db)
    try:
        load_raw_orders(spark.range(3), as_table=True)
        assert ids(spark.sql("SELECT * FROM raw_orders")) == [0, 1, 2]
    finally:
        spark.catalog.setCurrentDatabase("default")
    assert ids(spark.table(f"{db}.raw_orders")) == [0, 1, 2]


def test_a_build_publishes_its_tables_and_a_failed_one_does_not(spark, db, scratch):
    rows = [{"row_id": i, "order_id": f"O{i}"} for i in range(6)]
    K.write_by_year(clean_df(spark, rows), f"{scratch}/clean")  # raw_orders stays this file, in folders by year
    build_from_clean(spark, spark.read.parquet(f"{scratch}/clean"), f"{scratch}/one", raw_path=f"{scratch}/clean")
    publish(spark, f"{scratch}/one", db)
    assert {t.name for t in spark.catalog.listTables(db)} == set(TABLES)
    assert spark.table(f"{db}.raw_orders").where("order_year = 2014").count() == 6
    assert spark.sql(f"SELECT COUNT(*) FROM {db}.fact_sales JOIN {db}.dim_customer USING (customer_id)").first()[0] == 6
    build_from_clean(spark, clean_df(spark, rows[:2]), f"{scratch}/two")
    os.rename(f"{scratch}/two/_complete", f"{scratch}/two/_unfinished")
    with pytest.raises(ValueError, match="no finished warehouse"):
        publish(spark, f"{scratch}/two", db)
    assert spark.table(f"{db}.fact_sales").count() == 6
    os.rename(f"{scratch}/two/_unfinished", f"{scratch}/two/_complete")
    publish(spark, f"{scratch}/two", db)
    assert spark.table(f"{db}.fact_sales").count() == 2 and spark.table(f"{db}.raw_orders").count() == 2
    spark.sql(f"DROP TABLE {db}.dim_people")
    found = D.table_counts(spark, {t: C.table_or_none(spark, f"{db}.{t}") for t in ("fact_sales", "dim_people")})
    assert {r.table_name: r.rows for r in found.collect()} == {"fact_sales": 2, "dim_people": None}


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def reads(df, table):
    return sum(f"/{table}/" in f for f in df.inputFiles())


@pytest.mark.parametrize("defects", [False, True])
def test_marts_from_rollups_are_the_marts_from_lines(spark, scratch, defects):
    star = star_for(spark, SF_SMALL, defects=defects)
    stars = E.rolled_up(star, f"{scratch}/sums")
    for mart, (_file, build, _bounded) in E.MARTS.items():
        rolled = build(stars.get(E.MART_GRAINS.get(mart), star))
        assert values(rolled) == values(build(star)) and rolled.schema == build(star).schema, mart
    assert [m for m, (_f, build, _b) in E.MARTS.items()
            if reads(build(stars.get(E.MART_GRAINS.get(m), star)), "fact_sales")] == ["discount_profitability"]
    assert scans(E.grain_sums(star.fact_sales)) == 1


def test_marts_of_an_empty_fact(spark, scratch):
    star = build_star(clean_df(spark, []))
    out = K.export_all(star, f"{scratch}/marts")
    assert out["kpi_overview.csv"] == 1 and sum(out.values()) == 1


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_the_report_of_five_checks_reads_the_orders_once(spark):
    star = star_for(spark, SF_SMALL, defects=True)
    df = D.quality_report(star.raw_orders, star.raw_returns, star.raw_people)
    assert scans(df) == 3  # orders, returns, people
    got = {r.figure: r.value for r in df.collect()}
    for each in (D.missing_keys, D.negative_values, D.invalid_discount, D.null_distribution):
        for figure, value in each(star.raw_orders).first().asDict().items():
            assert got.pop(figure) == value
    counts = D.row_counts(star.raw_orders, star.raw_returns, star.raw_people).collect()
    assert got == {r.check: r.cnt for r in counts}


def facts(spark, *days_and_sales):
    rows = [{"row_id": i, "order_id": f"O{i}", "order_date": d, "sales": None if s is None else Decimal(s)}
            for i, (d, s) in enumerate(days_and_sales)]
    return build_star(clean_df(spark, rows)).fact_sales


def test_calendar_puts_missing_months_back(spark):
    day = dt.date
    fact = facts(spark, (day(2013, 3, 5), "10"), (day(2013, 12, 1), "20"), (day(2014, 3, 31), "30"),
                 (day(2014, 4, 1), None), (None, "7"))
    got = A.monthly_growth(fact, calendar=True).collect()
    assert [r.month for r in got] == [*(day(2013, m, 1) for m in range(3, 13)), *(day(2014, m, 1) for m in range(1, 5)), None]
    by = {r.month: r for r in got}
    assert by[day(2014, 3, 1)].revenue_last_year == 10.0 and by[day(2014, 3, 1)].yoy_pct == 200.0
    assert by[day(2014, 3, 1)].prev_month_revenue == 0.0 and by[day(2014, 3, 1)].mom_pct is None
    assert by[day(2014, 1, 1)].mom_pct == -100.0 and by[day(2014, 1, 1)].orders_count == 0
    assert by[day(2014, 4, 1)].revenue is None  # a month with lines keeps what its lines give
    assert by[None].revenue == 7.0 and by[None].prev_month_revenue is None
    # without the calendar the rows present follow one another, as before
    assert [r.prev_month_revenue for r in A.monthly_growth(fact).collect()] == [None, 10.0, 20.0, 30.0, None]


def test_calendar_of_years_and_of_nothing(spark):
    fact = facts(spark, (dt.date(2010, 1, 1), "10"), (dt.date(2013, 1, 1), "20"), (None, "5"))
    assert [tuple(r) for r in V.yearly_revenue(fact, calendar=True).collect()] == [
        (2010, 10.0, None, None), (2011, 0.0, 10.0, -100.0), (2012, 0.0, 0.0, None), (2013, 20.0, 0.0, None),
        (None, 5.0, None, None)]
    undated = facts(spark, (None, "5"))
    assert [tuple(r) for r in V.yearly_revenue(undated, calendar=True).collect()] == [(None, 5.0, None, None)]
    assert A.monthly_growth(facts(spark), calendar=True).count() == 0


def test_marts_from_rollups_ask_for_no_table_they_do_not_read(spark, scratch):
    from martlane.plans.warehouse import GradualStar

    rows = [{"row_id": i, "order_id": f"O{i // 2}", "customer_id": f"C{i % 3}", "product_id": f"P{i % 4}"} for i in range(12)]
    star = GradualStar(f"{scratch}/wh", clean_df(spark, rows))
    out = K.export_all(star, f"{scratch}/marts")
    assert out["customer_loyalty.csv"] == 3 and out["product_performance.csv"] == 4
    assert set(os.listdir(f"{scratch}/wh")) == {"raw_orders", "fact_sales", "dim_customer", "dim_product"}


def shuffled_columns(df):
    """The columns of every shuffle."""
    plan = df._jdf.queryExecution().executedPlan().initialPlan()

    def walk(node):
        out, kids = node.output(), node.children()
        own = [[out.apply(i).name() for i in range(out.size())]] if node.nodeName() == "Exchange" else []
        return own + [x for i in range(kids.size()) for x in walk(kids.apply(i))]

    return walk(plan)


def test_orders_by_discount_are_shuffled_without_their_sums(spark):
    rows = [{"row_id": i, "order_id": None if i == 5 else f"O{i // 2}", "sales": Decimal(i),
             "discount": [None, Decimal("0.10"), Decimal("0.20")][i % 3]} for i in range(9)]
    got = E.discount_profitability(build_star(clean_df(spark, rows)).fact_sales)
    assert all(set(c) <= {"_of", "order_id"} for c in shuffled_columns(got) if "order_id" in c)
    assert [(r.discount, r.orders, r.revenue) for r in got.collect()] == [(0.1, 3, 12.0), (0.2, 2, 15.0), (None, 3, 9.0)]


def test_orders_of_a_rollup_are_not_grouped_again_by_region(spark, scratch):
    rows = [{"row_id": i, "order_id": f"O{i // 3}", "customer_id": f"C{i % 2}", "order_date": dt.date(2014, 1, 1 + i % 5),
             "region": f"R{i % 4}"} for i in range(24)]  # orders of several customers and days, customers of several regions
    star = build_star(clean_df(spark, rows))
    build = E.MARTS["regional_performance"][1]
    plain, rolled = build(star), build(E.rolled_up(star, f"{scratch}/sums")["order"])
    assert values(rolled) == values(plain) and rolled.schema == plain.schema
    keys = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Aggregate(keys=[customer_id")
    assert keys(plain) > keys(rolled) == 0
