"""Compare every registered query with its DuckDB oracle.

Usage: python tools/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from kohort.plans import catalog  # noqa: E402
from kohort.session import get_session  # noqa: E402
from oracle_util import compare, duck_connection  # noqa: E402


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    catalog.load_all()
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck_connection(sf_dir)
    bad = 0
    for name, fn in catalog.QUERIES.items():
        if names and name not in names:
            continue
        sql = catalog.ORACLE.get(name)
        t0 = time.time()
        if sql is None:
            n = fn(spark, sf_dir).count()
            print(f"{name:32s} rows-only {n} ({time.time() - t0:.1f}s)")
            continue
        try:
            res = compare(spark, con, fn, sql, sf_dir)
        except Exception as exc:  # report and continue
            bad += 1
            print(f"{name:32s} ERROR {type(exc).__name__}: {str(exc)[:400]}")
            continue
        ok = res["exact"] and res["types_match"]
        bad += not ok
        status = ("EXACT" if ok else "TYPES" if res["exact"]
                  else "ROUNDED" if res["rounded"] else "MISMATCH")
        print(f"{name:32s} {status} rows {res['spark_rows']}/{res['oracle_rows']} ({time.time() - t0:.1f}s)")
        if not ok:
            print(json.dumps({k: v for k, v in res.items() if k not in ("exact", "rounded")},
                             default=str)[:1500])
        elif res["spark_types"] and any("decimal" in x for x in res["spark_types"]):
            print("   types", res["spark_types"], res["oracle_types"])
    print("not exact:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
