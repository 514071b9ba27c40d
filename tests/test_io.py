"""Readers and sinks round trips."""

from __future__ import annotations

import os

from conftest import SF_SMALL
from helpers import orders_df
from martlane.plans.warehouse import star_for
from martlane.sources import extracts as X
from martlane.sources import sinks as K


def test_csv_round_trip_with_spreadsheet_headers(spark, scratch):
    df = orders_df(spark, [{"row_id": 1, "postal_code": "00123"}, {"row_id": 2}])
    headers = {c: " ".join(w.capitalize() for w in c.split("_")) for c in df.columns}
    headers["sub_category"] = "Sub-Category"
    spaced = df.toDF(*[headers[c] for c in df.columns])
    K.write_csv(spaced, f"{scratch}/orders", single_file=True)
    back = X.read_orders(spark, f"{scratch}/orders", "csv")
    assert back.columns == df.columns
    from martlane.functions.numeric import to_money, to_whole

    typed = back.withColumns({c: to_money(c) for c in ("sales", "discount", "profit", "shipping_cost")} | {
        "row_id": to_whole("row_id"), "quantity": to_whole("quantity", "int")})
    assert sorted(typed.collect()) == sorted(df.collect())


def test_fallback_dates_as_text(spark, scratch):
    df = orders_df(spark, [{"order_date": "42000"}], text_cols=("order_date",))
    K.write_csv(df, f"{scratch}/o2", single_file=True)
    back = X.read_orders(spark, f"{scratch}/o2", "csv", dates_as_string=True)
    assert dict(back.dtypes)["order_date"] == "string" and back.first().order_date == "42000"


def test_parquet_round_trip_partitioned(spark, scratch):
    df = orders_df(spark, [{"row_id": i} for i in range(3)])
    K.write_parquet(df.withColumn("order_year", df.order_date.substr(1, 4)), f"{scratch}/p", "order_year")
    back = X.read_clean(spark, f"{scratch}/p")
    assert back.count() == 3 and X.source_row_count(spark, f"{scratch}/p") == 3


def test_export_all_counts(spark, scratch):
    star = star_for(spark, SF_SMALL)
    counts = K.export_all(star, scratch)
    assert list(counts) == ["kpi_overview.csv", "monthly_sales_trends.csv", "product_performance.csv",
                            "customer_loyalty.csv", "regional_performance.csv", "discount_profitability.csv"]
    assert counts["kpi_overview.csv"] == 1
    assert counts["customer_loyalty.csv"] == star.fact_sales.select("customer_id").distinct().count()
    assert os.path.isfile(f"{scratch}/kpi_overview.csv")
    back = spark.read.option("header", True).csv(f"{scratch}/monthly_sales_trends.csv")
    assert back.count() == counts["monthly_sales_trends.csv"]


def test_missing_source_raises(spark, scratch):
    import pytest

    with pytest.raises(FileNotFoundError):
        X.source_row_count(spark, f"{scratch}/nope")


def test_typed_read_understands_serial_dates(spark, scratch):
    import datetime as dt

    df = orders_df(spark, [{"row_id": 1, "order_date": "42000"}, {"row_id": 2, "order_date": "2014-01-02"},
                           {"row_id": 3, "order_date": "junk"}], text_cols=("order_date",))
    K.write_csv(df, f"{scratch}/o3", single_file=True)
    back = X.read_orders(spark, f"{scratch}/o3", "csv").orderBy("row_id")
    assert dict(back.dtypes)["order_date"] == "date"
    assert [r.order_date for r in back.collect()] == [dt.date(2014, 12, 27), dt.date(2014, 1, 2), None]


def test_export_all_parquet(spark, scratch):
    star = star_for(spark, SF_SMALL)
    counts = K.export_all(star, scratch, fmt="parquet")
    assert "monthly_sales_trends.parquet" in counts
    back = spark.read.parquet(f"{scratch}/monthly_sales_trends.parquet")
    assert back.count() == counts["monthly_sales_trends.parquet"]
    assert dict(back.dtypes)["month"] == "date"


def test_load_view_and_catalog_table(spark, scratch):
    from martlane.operators.load import load_raw_orders

    df = orders_df(spark, [{"row_id": i} for i in range(3)])
    load_raw_orders(df, "raw_orders_test_view")
    assert spark.sql("SELECT COUNT(*) AS n FROM raw_orders_test_view").first().n == 3
    spark.sql(f"CREATE DATABASE IF NOT EXISTS martlane_test LOCATION '{scratch}/db'")
    K.save_table(df, "martlane_test.raw_orders")                  # create or replace
    K.save_table(df.limit(1), "martlane_test.raw_orders", False)  # if not exists: kept as is
    assert spark.table("martlane_test.raw_orders").count() == 3
    spark.sql("DROP DATABASE martlane_test CASCADE")


def test_scale_conf_bounds():
    from martlane.session import scale_conf

    big = scale_conf(100 * 2**40)
    assert big["spark.sql.shuffle.partitions"] == "204800"
    assert scale_conf(100 * 2**40, max_shuffle_partitions=1000)["spark.sql.shuffle.partitions"] == "1000"
    assert scale_conf(1 << 30)["spark.sql.shuffle.partitions"] == "200"
    assert int(big["spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"]) > 0


def test_extract_files_match_the_adapter(spark):
    from martlane.plans.extract_store import extracts_for
    from martlane.sources.driver import driver_extracts

    ex = extracts_for(spark, SF_SMALL)
    direct = driver_extracts(spark, SF_SMALL)
    assert ex.orders.dtypes == direct.orders.dtypes  # (Parquet reads every column as nullable)
    for a, b in [(ex.orders, direct.orders), (ex.returns, direct.returns), (ex.people, direct.people)]:
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    dirty = extracts_for(spark, SF_SMALL, dirty=True)
    assert dirty.orders.count() > ex.orders.count()  # seeded exact duplicates
    assert dirty.returns.count() == ex.returns.count()


HARD = ['1,A,"Desk ""XL"", 12"" wide",5.00,3.0,150,1/2/2014,Kim', '2,B,"two\nlines, one field",1e12,2,7,31-07-2012,Lee',
        '3.0,C,plain,999999999999999.99,x,0.2,42000,', '4,D,plain,N/A,2.5,,1e300,Mo', '5,E,plain,5,1,0.1,99999999999,Mo',
        '6,F,plain,5.0,1,0.1,NaN,Mo', '6,F,plain,5.00,1,0.1,NaN,Mo', 'z,G,plain,5,1,0.1,soon,Mo']


def hard_orders(spark, scratch):
    with open(f"{scratch}/hard.csv", "w", newline="") as f:
        f.write("\n".join(["Row ID,Order ID,Product Name,Sales,Quantity,Discount,Order Date,Sales Rep", *HARD]))
    return X.read_orders(spark, f"{scratch}/hard.csv", "csv", dates_as_string=True, multi_line=True)


def test_quoted_csv_is_read_and_written_as_rfc_4180(spark, scratch):
    import csv
    import glob

    orders = hard_orders(spark, scratch)
    names = {r.row_id: r.product_name for r in orders.collect()}
    assert names["1.000000"] == 'Desk "XL", 12" wide' and names["2.000000"] == "two\nlines, one field"
    K.write_csv(orders.select("row_id", "product_name", "sales_rep"), f"{scratch}/out", single_file=True)
    with open(glob.glob(f"{scratch}/out/part-*.csv")[0], newline="") as f:
        rows = {r["row_id"]: r for r in csv.DictReader(f)}
    assert rows["1.000000"]["product_name"] == 'Desk "XL", 12" wide' and rows["1.000000"]["sales_rep"] == "Kim"
    assert rows["2.000000"]["product_name"] == "two\nlines, one field"
    again = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(f"{scratch}/out")
    assert {r.product_name for r in again.collect()} == set(names.values())


def test_cleaning_loses_no_value_unseen(spark, scratch):
    import datetime as dt
    from decimal import Decimal as D

    from martlane.operators.clean import CleanReport, clean_orders

    returns = spark.createDataFrame([("Yes", "A")], "returned string, order_id string")
    people = spark.createDataFrame([("P", "R")], "person string, region string")
    report = CleanReport()
    got = clean_orders(hard_orders(spark, scratch), returns, people, report=report)
    rows = {r.order_id: r for r in got.collect()}
    assert got.columns[-1] == "sales_rep" and rows["A"].sales_rep == "Kim"
    assert len(rows) == got.count() == 7  # 5.0 and 5.00 are one value: F's copy is dropped
    assert rows["B"].sales == D("1000000000000.00") and rows["C"].sales == D("999999999999999.99") and rows["D"].sales is None
    assert [rows[k].row_id for k in "ABCG"] == [1, 2, 3, None] and [rows[k].quantity for k in "ACD"] == [3, None, None]
    assert [rows[k].discount for k in "ABC"] == [None, None, D("0.20")]
    assert [rows[k].order_date for k in "ABCDEFG"] == [
        dt.date(2014, 1, 2), dt.date(2012, 7, 31), dt.date(2014, 12, 27), None, None, None, None]
    counts = report.get()
    assert counts["deduped.invalid_discount"] == 2 and counts["discount.nulled"] == 2
    assert {k: counts[f"unreadable.{k}"] for k in ("row_id", "quantity", "sales", "discount", "order_date")} == {
        "row_id": 1, "quantity": 2, "sales": 1, "discount": 0, "order_date": 4}


def test_date_formats_of_the_extract_come_first(spark):
    import datetime as dt

    from martlane.functions.dates import coerce_date

    df = spark.createDataFrame([("20140102",), ("2/1/2014",), ("42000",), (" 2014-01-02 ",)], "d string")
    formats = ("yyyyMMdd", "d/M/yyyy")
    got = [r.x for r in df.select(coerce_date("d", formats=formats).cast("date").alias("x")).collect()]
    assert got == [dt.date(2014, 1, 2), dt.date(2014, 1, 2), dt.date(2014, 12, 27), dt.date(2014, 1, 2)]


def test_half_even_sees_unrounded_money(spark):
    from decimal import Decimal as D

    from martlane.functions.numeric import to_money

    df = spark.createDataFrame([("0.125",), ("0.135",), ("-0.125",)], "m string")
    assert [r.x for r in df.select(to_money("m", half_even=True).alias("x")).collect()] == [D("0.12"), D("0.14"), D("-0.12")]
    assert [r.x for r in df.select(to_money("m").alias("x")).collect()] == [D("0.13"), D("0.14"), D("-0.13")]


def test_local_cluster_needs_a_named_checkpoint_folder():
    import pytest

    from martlane.session import checkpoint_root

    class Fake:
        class conf:
            get = staticmethod(lambda k, d=None: None)

        class sparkContext:
            master = "local-cluster[2,1,1024]"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError):
        checkpoint_root(Fake)


def test_compressed_csv_is_read_whole_from_files_of_bounded_rows(spark, scratch, monkeypatch):
    rows = [{"row_id": i, "order_id": f"O{i}", "product_name": f'Desk, "{i}"' if i % 3 else None} for i in range(50)]
    df = orders_df(spark, rows).coalesce(2)
    monkeypatch.setattr(K, "COMPRESSED_ROWS", 10)
    K.write_csv(df, f"{scratch}/gz", compression="gzip")
    K.write_csv(df, f"{scratch}/plain")
    files = [f for f in os.listdir(f"{scratch}/gz") if f.startswith("part-")]
    assert len(files) == 6 and all(f.endswith(".csv.gz") for f in files)  # 25 rows a partition, each file with its header
    gz, plain = (X.read_orders(spark, f"{scratch}/{d}") for d in ("gz", "plain"))
    assert gz.dtypes == plain.dtypes and gz.count() == 50
    assert gz.exceptAll(plain).count() == 0


def test_extracts_go_through_csv_files_smaller_than_their_text(spark):
    from martlane.plans.clean_keys import _through_csv, orders_extract

    orders = orders_extract(spark, SF_SMALL)
    folder = _through_csv(spark, orders, "orders")
    K.write_csv(orders, f"{folder}_plain")
    size = lambda d: sum(os.path.getsize(f"{d}/{f}") for f in os.listdir(d))
    assert 3 * size(folder) < size(f"{folder}_plain")
    assert spark.read.csv(folder, header=True).count() == orders.count()
