"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   tables to read (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names instead of the headline set, or "all"
"""

from __future__ import annotations

import json
import os
import sys
import time

from lettermill.queries import QUERIES
from lettermill.session import local_session

HEADLINE = [
    "usable_emails", "corpus_build", "mbox_scan", "jsonl_roundtrip", "write_by_split",
    "choose_body", "html_to_text", "clean_text", "reject_reasons", "head_per_source", "word_count",
    "lang_profile", "detect_language", "build_examples", "processing_stats", "language_distribution",
    "split_stats", "split_language_stats", "formality_counts", "style_report", "style_report_by_source",
    "top_openings", "top_words", "seeded_shuffle", "train_val_split", "render_chat", "build_vocab",
    "encode_sequences", "encode_splits", "compare_responses", "style_delta",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/region.parquet").count()  # start-up is not part of any query
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
