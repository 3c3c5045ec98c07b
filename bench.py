"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (input tables), BENCH_CPUS (local cores), BENCH_RUNS
(runs per query, the fastest counts), BENCH_QUERIES (comma-separated subset).

Tables that several queries share (cleaned, staged, enriched reviews, language
model, star schema, review store) are built once and timed on their own as
``build_*``; every other query runs in full each time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from opinara.plans import catalog  # noqa: E402
from opinara.session import configure  # noqa: E402

HEADLINE = [
    "clean_text_basic", "normalize_text", "text_metrics", "dedup_reviews", "staging_reviews_cleaned",
    "average_rating_per_bank", "bank_statistics", "detect_language", "language_model_accuracy",
    "sentiment_by_lexicon_join", "topic_vocabulary", "assign_topics", "fact_reviews",
    "branch_performance", "sentiment_trends", "topic_analysis", "customer_experience",
    "branch_ranking_in_bank", "negative_spike_alert", "incremental_reviews", "branch_performance_live",
    "pages_to_reviews", "pages_to_raw_reviews", "read_reviews",
]
SHARED = ["cleaned", "staged", "trained_language_model", "enriched", "star", "review_store", "live_star"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("opinara-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = configure(builder, initial_partitions=int(cpus)).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    def timed(action) -> float:
        start = time.perf_counter()
        action()
        return time.perf_counter() - start

    def consume(df: DataFrame) -> None:
        df.write.format("noop").mode("overwrite").save()

    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in SHARED:
        build = getattr(catalog, name)
        seconds[f"build_{name}"] = timed(lambda: build(spark, sf_dir))
    for name in wanted:
        query = catalog.QUERIES[name]
        seconds[name] = min(timed(lambda: consume(query(spark, sf_dir))) for _ in range(runs))
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in seconds.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
