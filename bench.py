"""Time the headline queries and print one line of JSON.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the number of local threads. Each query
writes all its rows to the ``noop`` sink; a first, untimed query warms the JVM up.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from conformance.queries import all_queries

HEADLINE = (
    "dedup_latest",
    "silver_orders",
    "silver_order_items",
    "validate_orders",
    "validation_report",
    "relationship_report",
    "quarantine_orders",
    "quarantine_order_items",
    "failed_rows_unique",
    "int_order_revenue",
    "int_inventory_position",
    "int_promotion_attribution",
    "fct_sales",
    "mart_daily_retail_kpis",
    "mart_promotion_performance",
    "order_header_reconcile",
    "x_sales_breakdown",
    "x_stockout_risk",
    "x_funnel",
    "x_upsert",
)


def run(spark: SparkSession, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    all_queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, sf_dir, "mart_daily_retail_kpis")
    times = {name: round(run(spark, sf_dir, name), 3) for name in sys.argv[1:] or HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
