"""Dense ids, the layout by year, and marts as one named file."""

from __future__ import annotations

import datetime as dt
import os

from conftest import SF_SMALL
from helpers import clean_df
from martlane.operators.numbering import dense_ids, numbered, range_dealt
from martlane.plans.warehouse import star_for
from martlane.sources import sinks as K
from pyspark.sql import functions as F


def numbers(spark, df, path, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        range_dealt(df, "k", ignore=("stamp",)).write.parquet(path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    return {(r.k, r.v): r.id for r in dense_ids(spark.read.parquet(path), "id").collect()}


def test_ids_are_dense_and_do_not_depend_on_the_split(spark, scratch):
    # a third of the rows shares one key; some have none
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 != 1, F.col("id")).alias("k"),
                                  F.col("id").alias("v"), F.rand().alias("stamp"))
    a = numbers(spark, df.repartition(1), f"{scratch}/a", 3)
    b = numbers(spark, df.repartition(13, "v"), f"{scratch}/b", 8)
    assert a == b and sorted(a.values()) == list(range(1, 5001))
    order = sorted(a, key=a.get)
    assert [k for k, _ in order] == sorted([k for k, _ in order], key=lambda k: (k is not None, k))
    assert numbers(spark, df.limit(0), f"{scratch}/c", 3) == {}


def test_fact_ids_follow_the_row_key(spark):
    fact = star_for(spark, SF_SMALL).fact_sales.select("sales_id", "row_id").orderBy("row_id").collect()
    assert [r.sales_id for r in fact] == list(range(1, len(fact) + 1))


def test_years_have_folders_and_only_changed_ones_are_rewritten(spark, scratch):
    path, day = f"{scratch}/by_year", lambda y, d=1: dt.date(y, 1, d)
    rows = [{"row_id": i, "order_date": day(2011 + i % 3, 1 + i % 28)} for i in range(300)] + [{"row_id": 999, "order_date": None}]
    K.write_by_year(clean_df(spark, rows), path)
    folders = sorted(x for x in os.listdir(path) if x.startswith("order_year="))
    assert [x[11:] for x in folders] == ["2011", "2012", "2013", "__HIVE_DEFAULT_PARTITION__"]
    assert all(sum(f.endswith(".parquet") for f in os.listdir(f"{path}/{x}")) == 1 for x in folders)
    old = {x: sorted(os.listdir(f"{path}/{x}")) for x in folders}
    K.write_by_year(clean_df(spark, [{"row_id": 1, "order_date": day(2012)}]), path, only_years=True)
    assert {x for x in folders if sorted(os.listdir(f"{path}/{x}")) != old[x]} == {"order_year=2012"}
    back = spark.read.parquet(path)
    assert {r.order_year: r["count"] for r in back.groupBy("order_year").count().collect()} == {2011: 100, 2012: 1, 2013: 100, None: 1}
    plan = back.where("order_year = 2012")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan.replace("#", "(", 0)


def test_bounded_marts_are_one_file_and_replaced_whole(spark, scratch):
    star = star_for(spark, SF_SMALL)
    counts = K.export_all(star, scratch)
    assert os.path.isfile(f"{scratch}/kpi_overview.csv") and os.path.isdir(f"{scratch}/customer_loyalty.csv")
    with open(f"{scratch}/kpi_overview.csv") as f:
        assert f.readline().startswith("total_revenue,") and counts["kpi_overview.csv"] == 1
    os.makedirs(f"{scratch}/old.csv")  # a folder of that name gives way
    K.write_one_csv(spark.range(3), f"{scratch}/old.csv")
    K.write_one_csv(spark.range(5), f"{scratch}/old.csv")
    assert spark.read.csv(f"{scratch}/old.csv", header=True).count() == 5
    assert not [x for x in os.listdir(scratch) if x.endswith(".writing")]


def test_rows_are_numbered_with_their_ranges_fixed_first(spark, scratch):
    """NULL and hot keys are parted by the other columns; the ids are those of
    one sort, whatever the number of ranges and the split of the input."""
    k = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 5 == 1, F.lit(None)).otherwise(F.col("id") % 900)
    df = spark.range(6000).select(k.alias("k"), F.when(F.col("id") % 7 != 0, F.concat(F.lit("v"), F.col("id") % 4000)).alias("v"),
                                  (F.col("id") / 8).cast("decimal(9,2)").alias("w"), F.rand().alias("stamp"))
    df.repartition(5).write.parquet(f"{scratch}/df")
    read = spark.read.parquet(f"{scratch}/df")
    plain = sorted(((r.k, r.v, r.w) for r in read.collect()), key=lambda r: [(x is not None, x) for x in r])
    for ranges in (1, 2, 13, 40):
        out = numbered(read, "k", "id", ranges, ignore=("stamp",))
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        rows = out.orderBy("id").collect()
        assert [r.id for r in rows] == list(range(1, 6001))
        assert [(r.k, r.v, r.w) for r in rows] == plain
        assert out.columns == ["id", "k", "v", "w", "stamp"]
        assert len(sizes) == ranges and max(sizes) < 2.5 * 6000 / ranges
    assert numbered(read.limit(0), "k", "id", 3).count() == 0


def test_the_fact_is_written_once(spark, scratch, monkeypatch):
    from martlane.plans import warehouse as W

    written, write = [], W._write
    monkeypatch.setattr(W, "_write", lambda df, path: (written.append(os.path.basename(path)), write(df, path)))
    star = W.GradualStar(f"{scratch}/wh", star_for(spark, SF_SMALL).raw_orders)
    fact = star.fact_sales
    assert written == ["raw_orders", "fact_sales"]
    assert dict(fact.dtypes) == dict(star_for(spark, SF_SMALL).fact_sales.dtypes)


def test_a_narrow_fact_becomes_the_same_fact_again(spark):
    from decimal import Decimal as D

    from martlane.operators.star import build_fact_sales, narrow_fact, wide_fact

    values = {"profit_margin": [None, 0.5, 1.0 / 3, 0.3333, float("nan"), 7.0], "discount": [None, D("-99.99"), D("99.99"), D("0.29")],
              "quantity": [None, -(1 << 31), (1 << 31) - 1, 0, -3], "returned": [None, "Yes", "No"], "sales": [None, D("0.00"), D("3.00")],
              "profit": [None, D("1.00"), D("-1.00")]}
    rows = [{c: v[i // (1 + k) % len(v)] for k, (c, v) in enumerate(values.items())} | {"row_id": i} for i in range(400)]
    fact = build_fact_sales(clean_df(spark, rows), with_sales_id=False).drop("created_at")
    fact = fact.withColumn("returned", F.when(F.col("row_id") % 5 != 0, F.col("returned")))
    narrow = narrow_fact(fact)
    kept = {r.row_id: r.profit_margin for r in narrow.collect()}
    assert "quantity" not in narrow.columns and 0 < sum(v is None for v in kept.values()) < 400
    back = wide_fact(narrow).select(*fact.columns)
    assert back.dtypes == fact.dtypes
    assert sorted(map(str, back.collect())) == sorted(map(str, fact.collect()))
