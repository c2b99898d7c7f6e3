"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_RUNS (default 2) choose the data, the cores and the timed runs per query,
after one that is not timed; the median is reported. Every query is computed
whole, into Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.catalog import QUERIES  # noqa: E402
from checks.compare import local_session  # noqa: E402

HEADLINE = (
    "clean_pages", "all_links", "page_link_sets", "min_words", "chunk_words", "speech_segments",
    "extractive_summary", "glossary_translate", "batch_inference", "rejoin_turns", "politeness_wait",
    "retry_resolution", "sorted_manifest", "new_links", "stage_lineage", "outcome_rollup",
    "scrape_outcome", "discovery_curve", "bounded_crawl", "append_metadata", "stream_clean",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.read.parquet(f"{sf_dir}/pages.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
