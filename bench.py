"""Wall time of the headline queries after a warm-up, one JSON line: the median of three runs."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pagewright.catalog import QUERIES
from pagewright.session import local_session

HEADLINE = [
    "S3_key_lookup", "S6_url_dictionary_upsert", "S7_document_upsert", "S8_link_insert_ignore",
    "F1_index_tokenizer", "F12_url_normalise", "F18_content_hash", "J1_referential_links",
    "J10_robots_join", "U1_distinct_union", "A1_term_counts", "A3_document_frequency",
    "W1_result_dedupe", "T1_top_k", "H7_content_table", "H6_link_extraction", "X1_inverted_index",
    "X2_field_weighted_index", "X3_search_cosine", "X15_full_search", "G3_sink_repair",
    "G10_pagerank", "C5_frontier_update", "C8_recrawl_plan", "C10_content_dedupe",
    "R10_crawl_stream",
]


def seconds(run) -> float:
    started = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in chosen:
        run = lambda: QUERIES[name](spark, folder)  # noqa: B023, E731
        seconds(run)
        times[name] = round(statistics.median(seconds(run) for _ in range(repeats)), 3)
        print(name, times[name], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
