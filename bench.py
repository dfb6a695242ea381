"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs once to warm up (JIT, file listing, plan caches) and then
is timed over a full execution (a no-op write, so every row is produced
but none is collected to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martwise.plans.registry import QUERIES  # noqa: E402
from martwise.session import build_session  # noqa: E402

HEADLINE = [
    "cashflow_daily", "payment_status", "customer_journey", "rfm_segments", "customer_aggregates",
    "fact_orders_union", "order_items_explode", "fact_payments", "fact_cart_events",
    "fact_bank_transactions", "dim_date", "dedup_first", "dq_amounts", "quality_report",
    "measure_sales", "revenue_ytd", "revenue_mom", "event_funnel",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    times = {}
    for name in names:
        run_once(spark, name, sf_dir)  # warm-up
        times[name] = round(run_once(spark, name, sf_dir), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
