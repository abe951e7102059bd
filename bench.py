"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalogue_queries import QUERIES  # noqa: E402
from catalogue_queries import checks, fixtures  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))

HEADLINE = [
    "series_stats",
    "dedup_keep_last",
    "record_bundles",
    "first_codes",
    "build_catalogue",
    "read_long_csv",
    "label_series",
    "expand_hierarchy",
    "series_by_rank",
    "series_cards",
    "value_histogram",
    "property_stats",
    "box_stats_by_table",
    "collapse_topk",
    "embed_text",
    "pca_2d",
    "map_l2_l3",
    "validate_level",
    "validation_summary",
    "stage_seconds",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Written catalogues and lines that navigation and checks read; not timed.
    fixtures.stored_catalogue(spark, SF_DIR)
    fixtures.stored_catalogue(spark, SF_DIR, embedded=True)
    checks.checked(spark, SF_DIR)
    took: dict[str, float] = {}
    for name in HEADLINE:
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        # The first run warms the JVM and is left out.
        took[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(took.values()), 3),
        "unit": "sec",
        "queries": took,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
