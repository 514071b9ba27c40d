"""Command line: the reference's three entry points on Spark.

  python -m martlane clean  --orders P --returns P --people P --out DIR [--fmt csv|parquet]
      clean the extracts; write DIR/cleaned_orders.csv and DIR/cleaned_orders.parquet
  python -m martlane build  --clean DIR/cleaned_orders.parquet --warehouse W [--database D]
      load + build the star at W (and make it catalog tables of D); print the
      smoke checks and table counts
  python -m martlane export --warehouse W --out DIR [--fmt csv|parquet]
      write the six report marts, print rows per file
  python -m martlane report --warehouse W --name KEY [--limit N] [--out DIR]
      show one analysis / check / measure (any star key of the query registry),
      whole unless --limit is given; with --out write it as Parquet instead

Exit codes: 0 ok, 1 missing input, 2 failure in a step.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict

from pyspark.sql import DataFrame

from martlane.operators import quality as D
from martlane.plans.registry import STAR_REPORTS as REPORTS
from martlane.plans.warehouse import TABLES, build_from_clean, existing_tables, open_warehouse, publish

COUNTED = ("fact_sales", "dim_date", "dim_customer", "dim_product", "dim_people")


def _show(df: DataFrame, limit: int | None = None) -> None:
    """Print rows as JSON, all of them unless ``limit`` is given (rows come
    partition by partition); says so when rows are left out."""
    for n, row in enumerate(df.toLocalIterator()):
        if limit is not None and n >= limit:
            print(f"more than {limit} rows: the rest is not shown", file=sys.stderr)
            return
        print(json.dumps(row.asDict(), default=str))


def _exists(spark, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="martlane")
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("clean")
    c.add_argument("--orders", required=True)
    c.add_argument("--returns", required=True)
    c.add_argument("--people", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--fmt", default="csv", choices=["csv", "parquet"])
    c.add_argument("--dates-as-string", action="store_true", help="kept for older calls: dates always are read as text")
    c.add_argument("--date-format", action="append", default=[], help="date format of the extract, tried first")
    c.add_argument("--multi-line", action="store_true", help="CSV fields hold line breaks: files cannot be split")
    c.add_argument("--single-line", action="store_true", help="kept for older calls: the default")
    b = sub.add_parser("build")
    b.add_argument("--clean", required=True)
    b.add_argument("--warehouse", required=True)
    b.add_argument("--database", help="make the tables catalog tables of this database")
    e = sub.add_parser("export")
    e.add_argument("--warehouse", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--fmt", default="csv", choices=["csv", "parquet"])
    r = sub.add_parser("report")
    r.add_argument("--warehouse", required=True)
    r.add_argument("--name", required=True, choices=sorted(REPORTS))
    r.add_argument("--limit", type=int)
    r.add_argument("--out")
    args = ap.parse_args(argv)

    from martlane.session import apply_scale, get_session

    spark = get_session()
    try:
        if args.cmd == "clean":
            from martlane.functions.dates import column_formats
            from martlane.operators.clean import DATE_COLUMNS, CleanReport, clean_orders, unmatched_of
            from martlane.sources.extracts import read_orders, read_people, read_returns
            from martlane.sources.records import quarantine
            from martlane.sources.sinks import write_by_year, write_csv

            for p in (args.orders, args.returns, args.people):
                if not _exists(spark, p):
                    print(f"ERROR: input not found: {p}", file=sys.stderr)
                    return 1
            apply_scale(spark, args.orders, args.returns)
            rep, formats, multi = CleanReport(), tuple(args.date_format), args.multi_line
            if args.fmt == "csv":  # malformed records stand apart, counted
                for name, p in (("orders", args.orders), ("returns", args.returns), ("people", args.people)):
                    q = quarantine(spark, p, f"{args.out}/quarantine/{name}", multi)
                    print(json.dumps({"extract": name, "records": q.read, "kept": q.kept, **q.apart}))
            orders = read_orders(spark, args.orders, args.fmt, dates_as_string=True, multi_line=multi, malformed="apart")
            found = column_formats(orders, tuple(c for c in DATE_COLUMNS if c in orders.columns))
            for name, f in found.items():  # one format a column; ties are told
                print(json.dumps({"dates": name, **asdict(f)}))
            cleaned = clean_orders(
                orders,
                read_returns(spark, args.returns, args.fmt, multi, "apart"),
                read_people(spark, args.people, args.fmt, multi, "apart"),
                date_formats=formats, column_formats=found, report=rep,
            )
            write_by_year(cleaned, f"{args.out}/cleaned_orders.parquet")
            print(json.dumps(rep.get()))
            _show(unmatched_of(spark.read.parquet(f"{args.out}/cleaned_orders.parquet")))
            write_csv(spark.read.parquet(f"{args.out}/cleaned_orders.parquet").drop("order_year"), f"{args.out}/cleaned_orders.csv")
        elif args.cmd == "build":
            if not _exists(spark, args.clean):
                print(f"ERROR: cleaned input not found: {args.clean}", file=sys.stderr)
                return 1
            apply_scale(spark, args.clean)
            star = build_from_clean(spark, spark.read.parquet(args.clean), args.warehouse, raw_path=args.clean)
            if args.database:
                publish(spark, args.warehouse, args.database)
            _show(D.summary(star.raw_orders))
            _show(D.table_counts(spark, existing_tables(spark, args.warehouse, COUNTED)))
        elif args.cmd == "export":
            from martlane.sources.sinks import export_all

            if not _exists(spark, f"{args.warehouse}/fact_sales"):
                print(f"ERROR: warehouse not found: {args.warehouse}", file=sys.stderr)
                return 1
            for name, rows in export_all(open_warehouse(spark, args.warehouse), args.out, args.fmt).items():
                print(json.dumps({"mart": name, "rows": rows}))
        elif args.cmd == "report":
            if args.name == "table_counts":  # also of an unfinished warehouse: missing tables count as null
                found = D.table_counts(spark, existing_tables(spark, args.warehouse, COUNTED))
            else:
                found = REPORTS[args.name](open_warehouse(spark, args.warehouse))
            if args.out:
                found.write.mode("overwrite").parquet(args.out)
            else:
                _show(found, args.limit)
    except Exception as exc:  # a failed step ends the run with code 2
        print(f"ERROR during {args.cmd}: {exc}", file=sys.stderr)
        return 2
    return 0


__all__ = ["main", "REPORTS", "TABLES"]

if __name__ == "__main__":
    raise SystemExit(main())
