"""Spark vs DuckDB comparison, the same shape as the driver's gate:
row count, column names, and an order-insensitive comparison of values."""

from __future__ import annotations

import math
import time

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if v is pd.NaT or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v).date()) if not hasattr(v, "hour") or (v.hour, v.minute, v.second) == (0, 0, 0) else str(pd.Timestamp(v))
    if hasattr(v, "item"):
        return v.item()
    return v


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, key: str, fn, sql: str, sf_dir: str, tol: float = 0.0) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_pd = sdf.toPandas()
    t1 = time.time()
    d_pd = con.execute(sql).df()
    t2 = time.time()
    res = {"key": key, "spark_rows": len(s_pd), "oracle_rows": len(d_pd),
           "spark_s": round(t1 - t0, 2), "oracle_s": round(t2 - t1, 2)}
    res["columns_match"] = sorted(s_pd.columns) == sorted(d_pd.columns)
    if not res["columns_match"]:
        res["spark_cols"], res["oracle_cols"] = sorted(s_pd.columns), sorted(d_pd.columns)
        res["ok"] = False
        return res
    a, b = rows_of(s_pd), rows_of(d_pd)
    mism = [(x, y) for x, y in zip(a, b) if not _eq(x, y, tol)]
    res["mismatches"] = len(mism) + abs(len(a) - len(b))
    res["first_mismatch"] = mism[:2]
    res["ok"] = res["mismatches"] == 0 and len(a) == len(b)
    return res


def _eq(x, y, tol):
    for u, v in zip(x, y):
        if u is None or v is None:
            if u is not v:
                return False
        elif isinstance(u, float) or isinstance(v, float):
            if tol == 0.0:
                if float(u) != float(v):
                    return False
            elif not math.isclose(float(u), float(v), rel_tol=tol, abs_tol=tol):
                return False
        elif u != v:
            return False
    return True
