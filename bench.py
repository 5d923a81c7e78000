"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from pathlib import Path
from statistics import median

from tidemark.plans import QUERIES
from tidemark.session import build_session

HEADLINE = [
    "customer_order_summary", "order_stats_by_status", "salary_stats_by_segment", "revenue_by_product",
    "segment_spending", "sql_left_join_counts", "customers_without_orders", "broadcast_join", "shuffle_join",
    "copartitioned_join", "salted_join", "hot_key_split_join", "salted_agg", "cube_levels", "cube3_revenue",
    "rollup_levels", "grouping_sets_totals", "regional_dashboard", "top_products_by_region", "monthly_growth",
    "running_revenue", "rank_orders_by_status", "range_query_avg", "partitioned_scan", "validate_orders",
    "clean_customers", "tolerance_join", "session_overlap_join", "multi_stream_correlation", "stream_tumbling",
    "stream_sliding", "stream_sessions", "stream_user_totals", "stream_word_count", "stream_stateful_sessions",
    "stream_tolerance_join",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["customer_order_summary"](spark, folder).write.format("noop").mode("overwrite").save()  # start up
    seconds: dict[str, float] = {}
    for key in HEADLINE:
        times = []
        for _ in range(1 if key.startswith("stream_") else runs):
            start = time.perf_counter()
            QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[key] = round(median(times), 3)
    print(json.dumps({
        "metric": "total_wall_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
