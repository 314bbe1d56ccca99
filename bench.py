"""Time the headline queries and print one JSON line.

Each query runs once to warm up code generation and once for the record. Rows are fully computed
and thrown away by the no-op sink, so neither column pruning nor a result limit shortens the work.

BENCH_SF_DIR  folder of the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_ALL     set to time every registered query
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from goldleaf.queries import QUERIES  # noqa: E402
from goldleaf.session import local_session  # noqa: E402

HEADLINE = [
    "silver_transactions",
    "silver_customers",
    "silver_franchises",
    "expectation_report",
    "gold_daily_sales_summary",
    "gold_customer_360",
    "gold_product_performance",
    "gold_franchise_performance",
    "gold_payment_analysis",
    "favorite_product",
    "clustered_write_scan",
    "run_row_counts",
    "snapshot_changes",
    "scd2_from_changes",
    "stream_ingest_silver",
    "taxi_features",
    "score_table",
    "train_fare_model",
    "unpack_payload",
    "inference_processed",
    "monitoring_row_counts",
    "monitor_quality",
    "monitor_profile",
    "monitor_drift_numeric",
    "monitor_drift_categorical",
]


def seconds(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "goldleaf-bench")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in QUERIES if os.environ.get("BENCH_ALL") else HEADLINE:
        seconds(spark, name, folder)
        times[name] = round(seconds(spark, name, folder), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
