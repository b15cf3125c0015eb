"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "clean_html",
    "clean_markdown",
    "match_multi",
    "silver_hackernews",
    "silver_reddit",
    "silver_producthunt",
    "land_hackernews",
    "land_producthunt",
    "increment_by_key",
    "pending_mentions",
    "lexicon_score",
    "scored_mentions",
    "resumable_scoring",
    "sentiment_daily",
    "sentiment_by_source",
    "leaderboard",
    "weekly_trend",
    "top_bottom_posts",
    "daily_rollup",
    "dq_report",
    "mention_leaderboard",
    "stream_refine",
]
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("mentionkit-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    # the first query of a session pays for its start
    QUERIES["table_counts"](spark, sf_dir).collect()
    seconds = {}
    for name in chosen:
        runs = []
        for _ in range(RUNS):
            started = time.perf_counter()
            # every row and column is produced, nothing is kept
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median_low(runs), 3)
    total = round(sum(seconds.values()), 3)
    sf = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
