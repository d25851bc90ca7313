"""Run registered queries against their DuckDB oracle.

usage: python tools/oracle_check.py [SF_DIR] [name-prefix ...]
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans.catalog import ORACLE_SQL, QUERIES  # noqa: E402
from tessera.plans.compare import compare, duckdb_connection  # noqa: E402
from tessera.session import build_session  # noqa: E402


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    prefixes = [a for a in args if not os.path.isdir(a)]
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb_connection(sf_dir)
    bad = 0
    for name in sorted(QUERIES):
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t = time.time()
        if name not in ORACLE_SQL:
            try:
                n = QUERIES[name](spark, sf_dir).count()
                print(f"ROWS {name}: {n} rows {time.time() - t:.1f}s")
            except Exception as e:  # noqa: BLE001
                bad += 1
                print(f"FAIL {name}: {type(e).__name__}: {str(e)[:400]}")
            continue
        try:
            rep = compare(spark, QUERIES[name], ORACLE_SQL[name], sf_dir, con)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: {type(e).__name__}: {str(e)[:600]}")
            continue
        status = "OK  " if rep["ok"] else "DIFF"
        bad += not rep["ok"]
        print(f"{status} {name}: {rep['rows_spark']}/{rep['rows_sql']} rows {time.time() - t:.1f}s"
              + (f"  TYPES {rep['types']}" if rep.get("types") else ""))
        if not rep["ok"]:
            print("   ", json.dumps({k: v for k, v in rep.items() if k != "ok"}, default=str)[:1500])
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
