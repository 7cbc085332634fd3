"""Time the headline queries on the given tables; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from starlift.queries.catalogue import catalogue
from starlift.session import local_session

# The pipeline's own builders, from the raw tables to the star schema.
HEADLINES = (
    "csv_roundtrip_products",
    "bronze_merge_customers",
    "bronze_merge_products",
    "bronze_order_items_new",
    "bronze_orders_new",
    "silver_order_sales_full",
    "silver_order_sales_incremental",
    "silver_stocks_snapshot",
    "gold_dim_products",
    "gold_dim_customers",
    "gold_dim_customers_new_rank",
    "gold_dim_customers_new_offset",
    "gold_dim_date",
    "gold_fact_sales",
    "gold_fact_sales_incremental",
    "gold_fact_stocks",
    "gold_fact_stocks_incremental",
    "pipeline_two_runs",
)


def run(query, spark, folder: str) -> float:
    """Seconds from building the query to having computed every row of it."""
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINES
    spark = local_session("starlift-bench", cores)
    queries = catalogue()
    for name in names:  # warm runs are compared: start-up is not a query's cost
        if not name.startswith("pipeline"):
            run(queries[name], spark, folder)
    seconds = {}
    for name in names:
        times = [run(queries[name], spark, folder) for _ in range(1 if name.startswith("pipeline") else runs)]
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder).removeprefix("sf"),
                "cores": int(cores),
                "runs": runs,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
