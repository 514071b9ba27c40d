"""Plan inspection: the checks a reviewer runs on ``explain`` output,
as functions (used by the tests, usable on any DataFrame)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")
AGG_NODES = ("HashAggregate", "SortAggregate", "ObjectHashAggregate")


def physical_plan(df: DataFrame) -> str:
    """The physical plan as text (AQE initial plan; no job is run)."""
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def python_nodes(df: DataFrame) -> list[str]:
    """Python evaluation nodes in the plan (the slow path); [] when JVM-only."""
    text = optimized_plan(df) + physical_plan(df)
    return sorted({n for n in PYTHON_NODES if n in text})


def cartesian_joins(df: DataFrame) -> int:
    text = physical_plan(df)
    return text.count("CartesianProduct") + text.count("BroadcastNestedLoopJoin")


def single_partition_exchanges_not_over_aggregate(df: DataFrame) -> list[str]:
    """Every ``Exchange SinglePartition`` should sit directly on an aggregate
    (partials in, one row per partition out); anything else funnels raw
    rows into one task."""
    lines = physical_plan(df).splitlines()
    bad = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = lines[i + 1] if i + 1 < len(lines) else ""
            if not any(a in child for a in AGG_NODES):
                bad.append(child.strip())
    return bad


def scan_columns(df: DataFrame) -> list[str]:
    """ReadSchema of every file scan in the plan."""
    return re.findall(r"ReadSchema: (struct<[^>]*>)", physical_plan(df))


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", physical_plan(df))
