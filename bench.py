"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the cores.
Every query runs twice and the better time counts; building the DataFrame, including what it
stages on the way, is part of the time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from checks.queries import QUERIES  # noqa: E402

HEADLINE = (
    "dim_snapshot_distinct", "area_scan", "append_new_only", "replace_campaign_slice",
    "active_campaigns", "day_window", "campaigns_by_area_receive",
    "campaigns_by_area_outcall", "success_rules_ranked", "orders_with_state",
    "receive_new_orders", "outcall_new_orders_area", "receive_changed_orders",
    "outcall_org_resolution", "grid_lookup_top1", "user_name_lookup", "org_hierarchy_flatten",
    "receive_success_candidates", "rule_eval", "rule_first_value", "receive_first_success",
    "outcall_success_executor", "receive_success_apply", "outcall_success_apply",
    "condition_explode", "callout_report_class", "callout_report_all_levels",
    "receive_report_sec", "receive_report_org", "receive_daily_run", "outcall_daily_run",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("orderflow-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.driver.memory", "12g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
