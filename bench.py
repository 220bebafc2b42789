"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the folder of test tables, ``BENCH_CPUS`` the local cores. Every
result is written in full to Spark's no-op sink, so no column is pruned away.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_transactions",
    "monthly_sales",
    "features",
    "features_labeled",
    "holiday_impact",
    "holiday_products",
    "quarterly_summary",
    "newyear_vs_christmas",
    "quarterly_heatmap",
    "feature_correlation",
    "metrics_classification",
    "product_index",
    "tfidf_weights",
    "description_clusters",
    "demand_forecast",
    "stock_forecast",
]


def session(cores: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shelfcast-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = session(cores)

    from checks.queries import REGISTERED

    def run(name: str) -> float:
        start = time.perf_counter()
        REGISTERED[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("features_labeled")  # untimed: loads classes and warms the file cache
    names = sys.argv[1:] or HEADLINE
    seconds = {name: run(name) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
