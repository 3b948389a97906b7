"""Time the headline queries: one warm-up, then the median of three full runs; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from tidemark.catalog import load_all
from tidemark.session import local_session

HEADLINE = [
    "B01_unique_reach_hour", "B01_unique_reach_video", "B02_daily_active", "B04_activity_metrics", "B06_fill_stats",
    "B07_user_sessions", "B08_click_labels", "B09_purchase_labels", "B10_resolve_all_products", "B11_user_histories",
    "B12_recency_profile", "B14_baskets", "B15_top_per_category", "B16_recent_products", "B18_segment_performance",
    "B20_reward_stats", "B21_budget_consumption", "B22_overspend_attribution", "B23_point_expiry", "B25_efficiency",
    "B27_payouts", "B29_settle_revenue", "D01_dedup_status", "D04_recent_plus_compacted", "U03_upsert", "U04_dedup_upsert",
    "U08_merge_latest", "W06_running_sum", "X03_sessions", "A01_group_by", "A02_distinct_counts", "S10_change_image",
]


def run(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "3"))
    keys = sys.argv[1:] or HEADLINE
    spark, catalog, times = local_session(cores, partitions=int(cores) if cores.isdigit() else 8, app="bench",
                                          scratch=tempfile.mkdtemp(prefix="bench-")), load_all(), {}
    for key in keys:
        run(catalog[key], spark, folder)
        times[key] = round(statistics.median(run(catalog[key], spark, folder) for _ in range(rounds)), 4)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": folder.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
