"""Benchmark: wall seconds of the headline queries.

Runs on ``local[$BENCH_CPUS]`` against ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1). Each query runs to completion through the ``noop``
sink (full execution, nothing collected to the driver), once cold and once
warm. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "deck_groupsize_summary",   # scan -> parse -> group context -> aggregate
    "neighborhood_density",     # range neighbours per deck (block join)
    "apply_domain_rules",       # ordered group imputation rules
    "impute_spend_group_aware", # group + global medians
    "null_summary", "numeric_stats", "chi2_test", "mann_whitney", "correlation_matrix",
    "imputation_opportunities",
    "fs_001", "fs_005", "fs_012", "fs_013", "fs_007",
    "stratified_split", "eval_metrics", "threshold_search", "segment_errors",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from lathe.plans import load_all
    from lathe.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                          app="lathe-bench")
    queries, _ = load_all()
    cold, warm = {}, {}
    for name in HEADLINE:
        for store in (cold, warm):
            t0 = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            store[name] = round(time.perf_counter() - t0, 3)
    total = round(sum(cold.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total_cold", "value": total, "unit": "sec",
                      "queries": cold, "warm": warm, "warm_total": round(sum(warm.values()), 3),
                      "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
