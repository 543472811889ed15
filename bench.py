"""Benchmark the headline reconciliation queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and materialises the full result with the ``noop``
sink (every row computed, nothing collected).  Before timing, every headline
query runs once on ``$BENCH_WARM_DIR`` (default the sf0.001 tables) to warm
the JVM.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "mismatch_cells",           # flagship: ordinal pairing + cell explode
    "unmatched_ordinals",
    "left_only_distinct",
    "count_differences",
    "count_difference_patterns",
    "mismatch_counts_by_column",  # cross pairing via frequencies
    "changed_cross",
    "mismatch_cells_cross",
    "business_mismatch_cells",
    "generic_mismatch_long",
    "keyless_diff",
    "spot_check",
    "run_status",               # whole duplicate-aware run summary
    "run_status_cross",         # the same under cross pairing
    "run_status_business",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from paritas.session import local_session
    from paritas.plans.catalog import QUERIES

    spark = local_session(cores=cpus, shuffle_partitions=max(8, cpus * 2), app="paritas-bench")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    # warm-up (not timed): JIT and codegen caches, by running every headline
    # query once on the smallest generated scale when it exists, so the timed
    # runs measure steady-state throughput rather than first-use compilation
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir, warm_keys = sf_dir, ["count_differences"]
    else:
        warm_keys = HEADLINE
    for key in warm_keys:
        QUERIES[key](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for key in HEADLINE:
        t = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
