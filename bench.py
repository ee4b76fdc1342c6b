"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then BENCH_RUNS times (default 3); the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillstream.session import build_session
from verification.queries import all_queries

HEADLINES = (
    "fct_commerce_orders",
    "sessions_seconds",
    "sessions_minute_boundary",
    "sessions_gap_360",
    "session_events_seconds",
    "dim_products",
    "order_kpis",
    "orders_page",
    "trend_month",
    "category_state_long",
    "commerce_insights",
    "session_insights",
    "event_histogram",
    "topic_fanout",
    "bronze_unseen",
    "dq_suite",
    "items_per_order",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINES
    spark = build_session(
        "bench",
        spark__master=f"local[{cores}]",
        spark__sql__shuffle__partitions=cores,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            all_queries()[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "sum of query medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
