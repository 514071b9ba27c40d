"""What the driver adapter shuffles: rows as small as the extract allows."""

from __future__ import annotations

import datetime as dt

import pytest

from martlane.sources.driver import orders_extract

DAY = dt.datetime(1995, 3, 4, 23, 59)
TABLES = {
    "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_linestatus string, l_shipdate timestamp",
                 [(1, 7, 1, 1, 3.0, 10.0, 0.1, 0.05, "F", DAY), (1, 7, 1, 2, 2.0, 20.0, 0.0, 0.0, "O", None),
                  (2, 9, 1, 1, 1.0, 5.0, 0.0, 0.0, None, DAY)]),
    "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
               "o_orderpriority string", [(1, 4, "P", 30.0, DAY, "1-URGENT"), (2, None, "O", 5.0, None, None)]),
    "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
                 [(4, "Ann", 0, 1.0, "S")]),
    "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
             [(7, "bolt", "B", "T", 1, 2.0)]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "N", 0)]),
    "region": ("r_regionkey int, r_name string", [(0, "R")]),
}


@pytest.fixture()
def extract(spark, scratch):
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{scratch}/{name}.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield orders_extract(spark, scratch, 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _shuffled(node) -> list[dict[str, str]]:
    """Columns and types of every shuffle below ``node``."""
    out, columns, children = [], node.output(), node.children()
    if node.getClass().getSimpleName() == "ShuffleExchangeExec":
        found = [columns.apply(i) for i in range(columns.size())]
        out.append({a.name(): a.dataType().simpleString() for a in found})
    return out + [s for i in range(children.size()) for s in _shuffled(children.apply(i))]


def test_lines_and_orders_are_dealt_without_time_stamps(extract):
    dealt = _shuffled(extract._jdf.queryExecution().executedPlan().initialPlan())
    lines = [s for s in dealt if "l_orderkey" in s]
    orders = [s for s in dealt if "o_orderkey" in s]
    assert len(lines) == 2 and len(orders) == 2  # by part and order, by customer and order
    assert all(s["l_shipdate"] == "date" and s["l_linestatus"] == "boolean" for s in lines)
    assert all(s["o_orderdate"] == "date" for s in orders)


def test_days_and_ship_modes_of_null_and_late_values(extract):
    rows = {r.row_id: (r.order_date, r.ship_date, r.ship_mode) for r in extract.collect()}
    day = DAY.date()
    assert rows == {11: (day, day, "Standard Class"), 12: (day, None, "First Class"), 21: (None, day, "First Class")}
