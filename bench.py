"""Times the headline queries and prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from trasvase.catalogue import QUERIES

HEADLINE = [
    "sales_clean", "stock_full", "assortment", "net_sales_ean", "stock_by_product", "store_product_kpis",
    "kpi_profile_view", "kpi_profile_legacy", "sales_missing_from_profile", "candidate_pairs", "transfer_allocation",
    "move_table", "rejected_pairs", "size_coverage_flag", "stuck_products", "allocation_log", "digest_html", "weekly_moves",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("trasvase-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").count()  # start executors before the clock
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": scale}
        )
    )


if __name__ == "__main__":
    main()
