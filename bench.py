"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from millrace.plans.queries import QUERIES  # noqa: E402

WARM_UP = "transactions_core"

HEADLINE = (
    "raw_row_count",
    "distinct_state_country",
    "lookup_country",
    "lookup_city",
    "lookup_product_type",
    "address_core",
    "address_core_keyed",
    "customers_core",
    "customer_dim",
    "products_core",
    "products_core_keyed",
    "product_dim",
    "transactions_core",
    "bronze_roundtrip",
    "landing_merge",
    "gold_row_counts",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("millrace-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run(WARM_UP)
    seconds = {name: run(name) for name in HEADLINE}
    spark.stop()
    print(json.dumps({
        "metric": "total wall clock of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
