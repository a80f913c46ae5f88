"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of the tables and BENCH_CPUS the local cores. Every
query runs once untimed on the same data first, so that the times do not hold the
start of the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from moodline.plans.queries import QUERIES  # noqa: E402
from moodline.session import local_session  # noqa: E402

HEADLINE = [
    "clean_messages",
    "parse_packets",
    "received_results",
    "score_documents",
    "score_emphasis",
    "batch_summary",
    "running_totals",
    "full_batches",
    "final_sentiment_by_client",
    "active_connections",
    "packet_counters",
    "trailing_rate",
    "trailing_rate_by_client",
    "session_durations",
    "session_cap",
    "client_stats",
    "status_snapshot",
    "draw_with_replacement",
    "serve_and_analyse",
    "stream_scores",
    "stream_batches",
]
WARM_UPS = 1


def seconds_of(query, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "moodline-bench")
    times = {}
    for name in HEADLINE:
        for _ in range(WARM_UPS):
            seconds_of(QUERIES[name], spark, sf_dir)
        times[name] = round(seconds_of(QUERIES[name], spark, sf_dir), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
