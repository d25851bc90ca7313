"""Benchmark: wall time of the headline queries.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints ONE JSON line. Each query is fully executed
with the ``noop`` sink (every row computed, nothing collected to the driver);
one warm-up query runs first so JVM start-up is not charged to a query.

usage: python bench.py [query-name ...]      (default: the headline set)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship_summary", "a15_dedup", "j04_asof", "w02_prev_leg", "w03_trailing", "a01_flag_sums",
    "j01_role_join", "a02_edge_list", "w04_percent_rank", "a13_five_number", "n01_zscore",
    "a05_null_profile", "a09_correlation", "u08_time_folds", "w07_deciles", "p26_box_filter",
    "t04_term_counts", "t11_tfidf", "t01_clean_a", "g03_pagerank", "l06_knn", "l07_bernoulli_nb",
    "l08_multinomial_nb", "m05_auc",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from tessera.session import build_session, release_scratch

    ckpt = os.environ.get("BENCH_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="tessera-bench-")
    spark = build_session(f"local[{cpus}]", app="tessera-bench", shuffle_partitions=int(cpus) * 2,
                          conf={"spark.checkpoint.dir": ckpt})
    spark.sparkContext.setLogLevel("ERROR")

    from tessera.plans.catalog import QUERIES

    # Warm-up on the smallest scale factor: JVM JIT and class loading are not
    # charged to the first measured query.
    warm_dir = os.path.join(os.path.dirname(os.path.normpath(sf_dir)), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in ("a03_counts", "flagship_summary"):
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        release_scratch(spark)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({"metric": "headline_total_wall", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
