"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8), BENCH_RUNS (3) and
BENCH_QUERIES (comma separated; default the headline list, ``all`` for every query).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from articleflow.plans import QUERIES
from articleflow.session import local_session

HEADLINE = [
    "incremental_load", "batch_dedupe", "antijoin_uid", "antijoin_url", "canonicalize", "dual_verdict",
    "history_writeback", "backfill_apply", "take_while_recent", "seen_streak_cutoff", "header_fill",
    "line_groups", "source_cap", "status_table", "digest_lines", "feed_items", "feed_registry_join",
    "text_date", "html_text", "page_listing", "page_blocks", "content_assemble", "scorer_job",
    "stream_ingest", "daily_digest",
]


def seconds(fn) -> float:
    start = time.perf_counter()
    fn()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session(cpus)
    times: dict[str, float] = {}
    for name in names:

        def run() -> None:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()  # warm the JVM and the file cache
        times[name] = round(statistics.median(seconds(run) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "articleflow headline queries, warm median", "value": round(sum(times.values()), 3),
                "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
