"""Headline queries on the benchmark tables; prints one JSON line.

Each query runs once to warm up and three times measured; the median is reported. Results go to the
`noop` sink, so all columns are computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.catalogue.queries import QUERIES
from millrace.session import build_session

HEADLINE = [
    "upsert_order_lines",
    "upsert_guarded_loads",
    "scd2_customer",
    "scd2_asof_join",
    "fx_asof",
    "fact_order_lines",
    "fact_inventory_daily",
    "fact_production",
    "fact_shipments",
    "fact_returns",
    "agg_order_metrics_daily",
    "agg_customer_scorecard",
    "agg_sku_performance",
    "agg_inventory_health",
    "agg_carrier_scorecard",
    "agg_demand_accuracy",
    "agg_cash_flow_monthly",
    "agg_production_quality",
    "silver_order_lines",
    "silver_payments",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name:32s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/"))
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
