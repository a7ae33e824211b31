"""Times the headline queries; prints one JSON line."""

import json
import os
import sys
import time
from statistics import median

from pyspark.sql import SparkSession

from ratelab.plans.registry import QUERIES

HEADLINE = (
    "edge_filter",
    "adjacency",
    "two_hop_count",
    "two_hop_paths",
    "triangles",
    "triangle_count",
    "triangle_count_shuffle",
    "triangle_count_broadcast",
    "parse_ratings",
    "rejects_count",
    "clean_books_mean",
    "clean_users_range",
    "books_dedup",
    "join_star",
    "hash_split",
    "bagged_sample",
    "exact_resample",
    "ensemble_average",
    "metrics_milli",
    "feature_index",
    "dt_regress",
    "clf_tree",
    "clf_naive_bayes",
    "clf_knn",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ratelab-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["edges_scan"](spark, sf_dir).count()

    timings = {}
    for name in names:
        seconds = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        timings[name] = round(median(seconds), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf_dir.rstrip("/").rsplit("/", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
