"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR picks the data set, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import time

from crestline.catalog.queries import QUERIES
from crestline.session import build_session

HEADLINE = (
    "trending", "daily_metrics", "engagement_trend", "engagement_decay_group", "engagement_decay_item",
    "score_decay", "score_trend", "findings_top", "predictions_daily_update", "view_timeseries",
    "country_stats", "title_resolution", "top_comments_latest", "upsert_merge", "counter_run_items",
    "flatten_movie_items_json", "flatten_credits_json", "jaccard_pairs", "lexicon_rate",
    "pooled_features", "scoring_job", "window_report", "window_report_by_item", "daily_counters_stream",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["title_resolution"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    took = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
