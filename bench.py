"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the
data and the cores. An operator query runs once to warm up and then BENCH_RUNS times
(default 3); its time is the median, from building the plan to the last row. The
products run last and once, on a warm session; their time includes building and
storing the dimensions they read.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from brokerdw.catalog import QUERIES
from brokerdw.session import build_session

HEADLINE = [
    "cash_balance",
    "forward_fill",
    "scd2_history",
    "pit_join",
    "interval_join",
    "high_low_52w",
    "trailing_sum4",
    "latest_record",
    "cond_min_max",
    "first_last_seen",
    "name_match_join",
    "quarter_left_join",
    "star_join_count",
    "merge_scd1",
    "merge_scd2",
    "cdc_scd1_batches",
    "cdc_out_of_order",
    "fixed_width_sec",
    "xml_scan",
]
PRODUCTS = ["dim_customer", "dim_account", "dim_security", "dim_trade", "fact_market_history"]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = sys.argv[1:] or [*HEADLINE, *PRODUCTS]
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        **{
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    times = {}
    for name in wanted:
        once = name in PRODUCTS
        if not once:
            run(spark, name, sf_dir)
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(1 if once else runs)), 3)
        print(f"{name:24s} {times[name]:8.3f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
