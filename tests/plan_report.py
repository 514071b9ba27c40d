"""Writes PLANS.md: the physical operators of every registered query as the
planner picks them when no table is small enough to broadcast (the 100 TB
case).  Only the explicit hints (1-row parameters)
remain broadcasts.

python tests/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martlane.session import get_session  # noqa: E402

NODES = [
    ("shuffles", r"Exchange hashpartitioning"),
    ("range", r"Exchange rangepartitioning"),
    ("single", r"Exchange SinglePartition"),
    ("broadcast", r"BroadcastExchange"),
    ("smj", r"SortMergeJoin"),
    ("bhj", r"BroadcastHashJoin"),
    ("expand", r"Expand \["),
    ("window", r"Window \["),
    ("topk", r"TakeOrderedAndProject"),
    ("sort_agg", r"SortAggregate"),
]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=16)
    from martlane.plans.registry import QUERIES
    from martlane.plans.warehouse import star_for

    star_for(spark, sf_dir)  # build with normal settings
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    rows = []
    for key, fn in QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        rows.append((key, [len(re.findall(p, plan)) for _, p in NODES]))
    head = "| query | " + " | ".join(n for n, _ in NODES) + " |"
    sep = "| --- |" + " --- |" * len(NODES)
    body = "\n".join(f"| `{k}` | " + " | ".join(str(v) for v in vals) + " |" for k, vals in rows)
    text = f"""# PLANS

Physical operators per registered query, planned with broadcast joins
disabled (as when every table is far above the broadcast threshold, the
100 TB case); explicit broadcasts remain only for the 25-row nation/region
code table and 1-row parameters.  Generated by `tests/plan_report.py` on
`{sf_dir}` (initial AQE plan, so a subtree used twice is counted twice;
at run time identical exchanges run once (stage reuse), and AQE may still
coalesce partitions, split skewed joins or switch a join to broadcast from
measured sizes).

Columns: `shuffles` hash exchanges, `range` range exchanges (final ORDER BY
of bounded results), `single` single-partition exchanges (always directly
above an aggregate - asserted in `tests/test_plans.py`), `broadcast`
broadcast exchanges, `smj` / `bhj` sort-merge / broadcast hash joins,
`expand` multi-distinct expansion, `window` window operators (only over
calendar- or taxonomy-bounded aggregates), `topk` TakeOrderedAndProject,
`sort_agg` sort-based aggregates (struct-valued min/max).

Reading guide: report queries over the written warehouse shuffle only
projected, pre-aggregated columns; the cleaning-rule keys read the extract
files (written once from the driver tables) and shuffle for the exact
duplicate drop and the returns join; `dq_orders_vs_returns_extract`
reads the Returns extract file.

{head}
{sep}
{body}
"""
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write(text)
    print(f"wrote PLANS.md ({len(rows)} queries)")


if __name__ == "__main__":
    main()
