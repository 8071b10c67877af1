"""Time the headline queries and print one JSON line.

Settings: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 2: one cold and one warm; the faster counts), BENCH_QUERIES
(comma list; ``all`` for every query).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shopgrain.plans.all_queries import QUERIES  # noqa: E402
from shopgrain.session import local_session  # noqa: E402

HEADLINE = [
    "top_products", "value_score", "quality_score", "union_sources", "dedup_first", "null_profile",
    "clean_text", "category_by_keywords", "aspect_sentiment", "sentiment_score",
    "fake_score_interactive", "nlp_summary", "category_rollup", "tfidf_vectors", "keyword_search",
    "vector_search", "similar_items", "query_items", "cooccurrence_scores", "l2_row_normalise",
    "collaborative_scores", "recommend_from_profile", "ranking_metrics", "daily_demand",
    "date_spine", "sliding_sequences", "forecast_metrics", "chat_last_turns", "topk_per_group",
    "balanced_sample", "product_document", "lag_regression_forecast", "stream_dedup", "stream_daily_demand",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE
    spark = local_session(cpus, cpus, **{"spark.ui.showConsoleProgress": "false"})
    seconds, cold = {}, {}
    for name in names:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            # The noop sink computes every column of every row and moves none to the driver.
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name], cold[name] = round(min(times), 3), round(times[0], 3)
        print(f"{name:28} cold {cold[name]:7.2f}  best {seconds[name]:7.2f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
                "unit": "sec", "queries": seconds, "cold": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
