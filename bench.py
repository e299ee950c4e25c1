"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1) and BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

from tailrace.table_queries import QUERIES

HEADLINES = (
    "interval_metrics topic_stats assign_topics redirect_audit server_load latest_owner running_offset rollover "
    "rollover_documents gap_audit fair_batch pending_messages replay_set fold_status_counters message_ids "
    "order_log topic_log_round_trip count_blob_round_trip tail_round_trip stream_interval_metrics "
    "rollover_in_segments stream_sink stream_status_counters progress_round_trip"
).split()

WARM_UP = ("interval_metrics", "topic_log_round_trip", "stream_interval_metrics")
WARM_UP_DIR = "/root/testdata/sf0.001"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tailrace-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Starting Python workers and loading classes is not what the queries cost: a small run comes first.
    for name in WARM_UP:
        QUERIES[name](spark, WARM_UP_DIR).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
