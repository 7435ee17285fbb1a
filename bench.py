"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion with the ``noop`` sink (full plan, no
driver collection) and timed; one JSON line is printed:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vellum.plans import QUERIES  # noqa: E402
from vellum.session import get_spark  # noqa: E402

HEADLINE = [
    "ttst_chain", "ttst_upsert", "ttst_diff", "price_chain", "asof_cost_join", "dedupe_last",
    "reshape_common_fact", "shred_parameters", "shred_responses", "usage_cost_by_role", "reply_parse",
    "model_id_prefix_match", "page_payload_extract", "domain_probe", "column_domains", "subject_area",
    "sieve_roles", "knn_per_collection", "prefilter_knn", "running_total", "correlated_counts",
    "table_regions", "schema_match", "page_runs", "price_refresh", "spec_refresh", "reply_validate", "path_steps", "usage_cost_by_model",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", app="vellum-bench", shuffle_partitions=int(cpus) * 2,
                      extra={"spark.driver.memory": "16g"})
    # warm-up: JVM class loading and codegen caches, not timed
    QUERIES["unified_stats"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.time()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
