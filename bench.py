"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores. Each query runs once
to warm up and then three times into a no-op sink; its time is the median. ``--all`` runs every
registered query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

import registry
from campaign_analytics.session import BUILDER, configure

HEADLINE = [
    "recommend_category",
    "worked_category",
    "applied_preference",
    "seen_preference",
    "unfulfilled_revenue",
    "eligible_preference",
    "recommendation_payloads",
    "basis_report_costs",
    "contacts_placing_orders",
    "channel_detail",
    "touch_source",
    "first_touch",
    "channel_counts",
    "tracker_link",
    "page_event",
    "deep_links",
    "ab_significance",
    "split_in_half",
    "nps_daily",
    "latest_attributes",
    "anonymize_users",
    "delete_payloads_exact",
    "validate_leads",
    "job_feed",
    "job_view",
    "review_decisions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("campaign-analytics-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config(map=BUILDER)
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    names = list(queries) if "--all" in sys.argv else HEADLINE

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in names:
        run(name)
        times[name] = round(statistics.median(run(name) for _ in range(3)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
