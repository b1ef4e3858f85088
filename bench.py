"""Time the headline queries; prints one JSON line.

Settings: BENCH_SF_DIR (tables), BENCH_CPUS (local threads), BENCH_REPEATS (timed runs after one warm-up).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from postflow import build_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "classify_posts",
    "classify_large_dictionary",
    "classify_keep_unmatched",
    "classify_collapse_orgs",
    "normalise_classified",
    "publish_posts",
    "spam_filter",
    "matched_keywords",
    "spam_flag_large",
    "matched_short_terms_shuffled",
    "dedupe_latest",
    "compact_dedup",
    "insert_missing_single_key",
    "insert_missing_composite",
    "insert_missing_full_row",
    "append_missing_table",
    "parse_json_events",
    "split_variations",
    "window_last",
    "window_prev_delta",
    "property_sales",
    "dq_contract",
    "stream_parse_properties",
    "stream_classify",
    "stream_window_last",
    "stream_prev_delta",
    "stream_property_sales",
    "stream_insert_missing",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        driver_memory="8g",
        conf={
            "spark.sql.shuffle.partitions": cpus,
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
        log_level="ERROR",
    )
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
