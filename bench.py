"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

BENCH_QUERIES=all times every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from driver_queries import QUERIES  # noqa: E402

HEADLINE = (
    "q_clean_text",
    "q_match_normalize",
    "q_prefilter_spread",
    "q_prefilter_dictionary",
    "q_term_hits",
    "q_standardize",
    "q_first_wins",
    "q_first_wins_hot",
    "q_skip_seen",
    "q_classify_full",
    "q_classify_prefilter_only",
    "q_usage_cost",
    "q_lid_profile",
    "q_lid_ladder",
    "q_incremental",
    "q_manual_json",
    "q_jobs",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else (chosen.split(",") if chosen else list(HEADLINE))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("talkloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        # The tables are a few files of some MB: smaller splits keep all cores busy.
        .config("spark.sql.files.maxPartitionBytes", str(4 * 1024 * 1024))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("q_prefilter_spread")  # JVM warm-up
    times = {}
    for name in names:
        times[name] = round(run(name), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
