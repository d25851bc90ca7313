"""Physical-plan summary of registered queries -> PLANS.md.

For every query: shuffles (Exchange), sorts, windows, join strategies,
cartesian / nested-loop joins (should be none), Python operators, and how many
columns each parquet scan reads. Plans are the AQE initial plans at the given
scale factor.

usage: python tools/plan_report.py [SF_DIR] [name-prefix ...]
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans.catalog import QUERIES  # noqa: E402
from tessera.session import build_session  # noqa: E402

COUNT = [("Exchange", r"\bExchange\b"), ("Sort", r"\bSort\b"), ("Window", r"\bWindow\b"),
         ("WindowGroupLimit", r"WindowGroupLimit"), ("SMJ", r"SortMergeJoin"),
         ("BHJ", r"BroadcastHashJoin"), ("SHJ", r"ShuffledHashJoin"),
         ("NestedLoop/Cartesian", r"BroadcastNestedLoopJoin|CartesianProduct"),
         ("Python", r"MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas")]


def summarize(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    counts = {k: len(re.findall(p, plan)) for k, p in COUNT}
    schemas = re.findall(r"ReadSchema: struct<(.*?)>(?:,|$|\n| )", plan)
    widths = sorted({len(re.findall(r"(?:^|,)\w+:", s)) for s in schemas})
    counts["scan cols"] = ",".join(map(str, widths)) or "-"
    counts["pushed filters"] = "yes" if re.search(r"PushedFilters: \[[^\]]", plan) else "-"
    return counts


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    prefixes = [a for a in args if not os.path.isdir(a)]
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    rows = []
    for name in sorted(QUERIES):
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        try:
            rows.append((name, summarize(QUERIES[name](spark, sf_dir))))
        except Exception as e:  # noqa: BLE001
            rows.append((name, {"error": type(e).__name__}))
    cols = [k for k, _ in COUNT] + ["scan cols", "pushed filters"]
    out = ["# Physical plans of the registered queries", "",
           f"Generated by `tools/plan_report.py` at `{sf_dir}` (AQE initial plans; queries that",
           "iterate or fit models show only their final plan). `NestedLoop/Cartesian` must be 0;",
           "`Python` marks the Arrow-batched mapInPandas steps (k-NN, mixture E-step).", "",
           "| query | " + " | ".join(cols) + " |", "|---|" + "---|" * len(cols)]
    for name, c in rows:
        out.append(f"| {name} | " + " | ".join(str(c.get(k, c.get("error", ""))) for k in cols) + " |")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"),
              "w") as fh:
        fh.write("\n".join(out) + "\n")
    print("\n".join(out[-len(rows):]))


if __name__ == "__main__":
    main()
