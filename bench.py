"""Timings of the headline queries, as one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Each query runs once to warm up and then BENCH_RUNS times;
the median counts. ``first_run`` has the warm-up, which also lands the tables that jobs hand on (raw input included). Results go to the no-op sink, so nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skyledger.plans import all_queries  # noqa: E402
from skyledger.session import build_session, local_scratch, release_scratch  # noqa: E402

HEADLINE = [
    "x01_standardize",
    "x03_allocate_compute",
    "x05_allocate_with_residual",
    "x06_allocate_untagged_one_tag",
    "x06_allocate_untagged_three_tags",
    "x07_unit_cost",
    "x08_classify_usage",
    "x09_pivot_all_dimensions",
    "w02_share_of_group",
    "w07_carried_lag",
    "m02_counter_rate",
    "m08_pod_daily_usage",
    "j10_l08_block_enrichment",
    "a13_cdn_dimension_sets",
    "t01_t03_stream_partial_minutes",
    "r05_expand_rules",
    "r07_w06_t07_evaluate_alarms",
    "e07_u08_audit_findings",
    "e11_notification_feed",
    "i03_inventory_subnets",
    "i06_snapshot_increment",
    "c01_required_tags",
    "c04_propagate_tags",
    "l07_cdn_log_by_header",
    "x11_monthly_cost",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark_sql_shuffle_partitions=cpus, spark_driver_memory=os.environ.get("BENCH_MEMORY", "16g")
    )
    spark.sparkContext.setLogLevel("ERROR")
    local_scratch(spark)
    known = all_queries()
    timings: dict[str, float] = {}
    first: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            known[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        first[name] = round(taken[0], 3)
        timings[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "first_run": first,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    release_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
