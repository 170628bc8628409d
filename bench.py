"""Wall time of the headline queries, as one JSON line.

Each query is built and run to a sink that drops the rows: once to warm up, then three
times, of which the median counts.  BENCH_SF_DIR and BENCH_CPUS choose tables and cores.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from checks.compare import local_spark
from checks.registry import queries

HEADLINE = (
    "daily_revenue",
    "funnel_by_referrer",
    "revenue_by_device_os",
    "ltv_segments",
    "copurchase_pairs",
    "cohort_revenue",
    "product_popularity",
    "revenue_by_category",
    "category_revenue_allocated",
    "clv_features",
    "clv_tier",
    "engagement_features",
    "unified_profile",
    "user_session_rows",
    "product_performance_daily",
    "recent_sessions",
)
RUNS = 3


def seconds(spark, query, directory: str) -> float:
    started = time.perf_counter()
    query(spark, directory).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_spark(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    for name in HEADLINE:
        seconds(spark, known[name], directory)
    medians = {
        name: round(
            statistics.median(seconds(spark, known[name], directory) for _ in range(RUNS)), 3
        )
        for name in HEADLINE
    }
    report = {
        "metric": "headline_total",
        "value": round(sum(medians.values()), 3),
        "unit": "sec",
        "queries": medians,
        "sf": os.path.basename(directory).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
