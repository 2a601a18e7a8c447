"""Times the headline queries: one warm-up, then the median of three runs.

Reads ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; each result is consumed whole by
the no-op sink. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from orderlake import registry, session

RUNS = 3
HEADLINE = [
    "top_sellers",
    "top_categories",
    "monthly_revenue",
    "daily_revenue",
    "active_customers_by_day",
    "sales_by_customer",
    "product_performance",
    "silver_orders",
    "silver_items",
    "silver_payments",
    "reviews_valid",
    "silver_customers",
    "scd2_versions",
    "scd2_merge",
    "scd2_changes_only",
    "scd2_rebuild",
    "fact_orders",
    "fact_order_items",
    "fact_payments",
    "stream_orders_to_silver",
]


def _runnable(name: str):
    """Facts are timed as the library builds them, without the key lookups that
    the registered queries add for comparison."""
    if name == "fact_orders":
        return lambda spark, sf: registry.Lake(spark, sf).fact_orders()
    if name == "fact_order_items":
        return lambda spark, sf: registry.Lake(spark, sf).fact_order_items()
    if name == "fact_payments":
        return lambda spark, sf: registry.gold.fact_payments(
            registry.Lake(spark, sf).payments, registry.Lake(spark, sf).fact_orders()
        )
    return registry.QUERIES[name]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session.build(
        f"local[{cpus}]",
        "bench",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "5g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    for name in names:
        run = _runnable(name)
        taken = []
        for _ in range(RUNS + 1):
            started = time.perf_counter()
            run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(name, [round(t, 2) for t in taken], file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
