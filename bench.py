"""Times the headline queries and prints one JSON line.

Each query runs twice into a sink that keeps nothing; the second run counts.
BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strataloom.plans import load_all  # noqa: E402
from strataloom.session import local_session, scratch_run  # noqa: E402

HEADLINE = [
    "daily_kpi_moving_avg", "star_fact_sales", "fraud_score", "scd2_build", "pit_join_orders",
    "merge_upsert", "merge_conditional_soft_delete", "snapshot_diff", "incremental_overlap",
    "incident_correlation", "funnel_conversion", "sales_dashboard", "rfm_segments", "top_products",
    "ledger_amendments", "readmission_kpi", "zscore_outliers", "market_median_quarter",
    "subscriber_profile_or_join", "moving_anomaly_2sigma", "supplier_scorecard", "demand_signals",
    "expectations_report", "keyed_hash", "k_hop", "pagerank",
]


def timed(query, spark, folder: str) -> float:
    with scratch_run(spark):
        start = time.perf_counter()
        query(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    found = load_all()
    spark = local_session(cpus, "bench")
    spark.conf.set("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
    seconds = {}
    for name in names:
        timed(found[name], spark, folder)
        seconds[name] = round(timed(found[name], spark, folder), 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
