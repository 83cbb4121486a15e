"""Time registered queries and print one JSON line.

BENCH_SF_DIR  input folder (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default 8)
BENCH_RUNS    timed runs per query after one warm-up; the median counts (default 3)
BENCH_SCRATCH folder for checkpoints and intermediate tables (default: a new temporary one)
BENCH_KEYS    comma-separated query keys, or "all" (default: the headline queries)
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from starloom.session import build_session
from starloom.suite import queries

HEADLINE = (
    "top_songs top_artists top_users plays_by_weekday plays_by_month songplay_inner songplay_left_hash songplay_lookup "
    "unmatched_keys user_latest user_one_per_key latest_per_key_rank time_dimension_distinct query_by_session query_by_song "
    "arrivals_fact previous_visits previous_visits_star previous_visits_spread daily_counts ml_features funnel_counts "
    "null_profile describe_columns value_counts_star quality_report partition_refresh append_new upsert_export "
    "incremental_events listening_load arrivals_load overstay_scores"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_KEYS", "")
    registered = queries()
    keys = list(registered) if chosen == "all" else chosen.split(",") if chosen else HEADLINE

    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus,
        spark_driver_memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark_ui_showConsoleProgress="false",
        spark_checkpoint_dir=os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(key: str) -> float:
        start = time.perf_counter()
        registered[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for key in keys:
        once(key)
        seconds[key] = round(statistics.median(once(key) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "total_wall_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus),
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
