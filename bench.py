"""Time the headline queries; print one JSON line.

Every query is run in full: all columns of all rows go to a sink that drops them. The best of the runs counts, after one
warm-up of the session.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from evalspark.plans import catalog

HEADLINE = [
    "flagship_leaderboard",
    "c1_explode_task_metrics",
    "c17_convert",
    "f1_flatten",
    "v0a_violations",
    "v0c_violation_summary",
    "s2_read_shards",
    "s4_write_results",
    "s5_shard_key",
    "s7_append_new",
    "s8_stream_results",
    "s9_stream_convert",
    "q3_latest_by_model",
    "q3_latest_by_model_row",
    "q4_leaderboard",
    "q7_trend",
    "q8_latest_by_model_task",
    "q9_summary_pivot",
    "q11_facets",
    "q14_dataset_stats",
    "t1_strip_think",
    "t3_completion_predictions",
    "t6_pass_at_k",
    "t7_render_prompts",
    "t8_first_n_per_task",
    "a1_summarize_runs",
    "a3_tool_call_status",
    "a4_steps_from_calls",
    "a6_runs_to_results",
    "r1_latency_summary",
    "r3_concurrency_speedup",
    "r4_stream_timing",
    "r5_per_example_cost",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    # One machine runs the bench, so any folder is shared. It goes when the bench ends.
    with tempfile.TemporaryDirectory(prefix="evalspark-bench-") as shared:
        measure(sf_dir, cpus, runs, names, shared)


def measure(sf_dir: str, cpus: str, runs: int, names: list[str], shared: str) -> None:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("evalspark-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "7g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        # Each table is one file of one row group, which no reader setting splits.
        .config("spark.evalspark.input.partitions", cpus)
        .config("spark.checkpoint.dir", shared)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["q14_dataset_stats"](spark, sf_dir).collect()
    seconds = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    sf = sf_dir.rstrip("/").rsplit("/sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
