"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the tables' folder, BENCH_CPUS the number of local threads and
BENCH_RUNS how often each query is timed after one warm-up; the median counts.
BENCH_QUERIES may name other queries, with commas.
"""

import json
import os
import statistics
import time

from rulespark import build_session
from rulespark.checks.queries import all_queries

HEADLINES = (
    "a6_load", "a7_cast", "b4_rules_for_feed", "b5_rules_for_packages", "b8_has_feed_mapping", "b9_approved_rules",
    "c1_first_event", "c1_key_overlap", "c1_neg_balance", "c1_orphan_line", "c1_region_total", "c1_stale_order",
    "c4_big_discount", "c4_user_gap", "c8_run_rules", "d3_ledger_append", "e1_started_rows", "e2_final_rows",
    "e4_latest_status", "e5_status_history", "e8_latest_stream", "f2_categories", "f5_verdict",
    "f6_exceptions_in_time", "f6_stream", "f7_all_succeeded_v1", "f8_exceptions_applied_v1", "f9_verdict_v1", "f11_run",
)


def seconds(query, spark, sf_dir):
    begun = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINES)).split(",")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("OFF")
    times = {}
    for name, query in all_queries().items():
        if name in names:
            seconds(query, spark, sf_dir)
            times[name] = round(statistics.median(seconds(query, spark, sf_dir) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": sf_dir.rstrip("/").rpartition("sf")[2], "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
