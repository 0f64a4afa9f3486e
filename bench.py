"""Time the headline queries: one warm-up run each, then the median of three.

The whole analyses, which fit many models, run once after the others.
"""

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES

HEADLINE = (
    "curate_posts",
    "dedup_posts",
    "track_filter",
    "idf_weights",
    "tf_idf",
    "post_sentiment",
    "bayes_predict",
    "wssse",
    "kmeans_grid",
    "batch_window_counts",
    "window_counts",
    "sink_by_time",
)
WHOLE = ("doc_vectors", "cluster_posts", "classify_posts", "live_analyze")
RUNS = 3


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        seconds(spark, name, sf_dir)
        times[name] = round(
            statistics.median(seconds(spark, name, sf_dir) for _ in range(RUNS)), 3
        )
    for name in WHOLE:
        times[name] = round(seconds(spark, name, sf_dir), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
