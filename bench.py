"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from moodloom.plans.catalog import QUERIES
from moodloom.session import get_spark

HEADLINE = [
    "clean_tweet", "vader_scores", "daily_sentiment", "topic_kpis", "tfidf_weights",
    "ingest_dedup", "stratified_split", "train_lr", "predict_batch",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = get_spark("bench", int(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["topic_detect"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
