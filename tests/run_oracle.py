"""CLI: compare every registered query with its SQL oracle.

python tests/run_oracle.py [sf_dir] [key ...]
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from oracle_harness import compare, duck  # noqa: E402

from martlane.session import get_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    q, o = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys or list(q):
        if k not in o:
            df = q[k](spark, sf_dir)
            print(json.dumps({"key": k, "rows_only": df.count()}))
            continue
        try:
            r = compare(spark, con, k, q[k], o[k], sf_dir)
        except Exception as e:  # report and continue
            r = {"key": k, "ok": False, "error": repr(e)[:800]}
        bad += not r.get("ok")
        print(json.dumps(r, default=str))
    print(f"FAILED {bad}" if bad else "ALL OK")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
