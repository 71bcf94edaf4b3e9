"""Schemas and fixed values of the measurement model."""

from __future__ import annotations

from pyspark.sql import types as T

SCHEMA_VERSION = "1"

# --- fixed values: must equal the published schema and converter tables ---------------------------
TRIGGERS = ["schedule", "pr", "workflow_dispatch", "local"]

SUITES = [
    "throughput",
    "ttft",
    "tool-calling",
    "code-accuracy",
    "framework-eval",
    "capability-comparison",
    "coding",
    "reasoning",
    "knowledge",
    "evalplus",
    "math-hard",
]

REQUIRED_KEYS = [
    "schema_version",
    "timestamp",
    "git_sha",
    "trigger",
    "suite",
    "model",
    "system",
    "results",
]

# Metric key in a task-evaluation document -> metric name in a result row.
TASK_METRIC_NAMES = {
    "exact_match,flexible-extract": "exact_match_flexible",
    "exact_match,strict-match": "exact_match_strict",
    "acc,none": "accuracy",
    "acc_norm,none": "accuracy_normalized",
    "pass@1,none": "pass_at_1",
}

# Key in a serving-benchmark document -> (metric name, unit).
SERVING_METRICS = {
    "output_throughput": ("throughput_output_toks_per_s", "tok/s"),
    "total_token_throughput": ("throughput_total_toks_per_s", "tok/s"),
    "request_throughput": ("throughput_requests_per_s", "req/s"),
    "median_ttft_ms": ("ttft_p50_ms", "ms"),
    "p99_ttft_ms": ("ttft_p99_ms", "ms"),
    "median_itl_ms": ("itl_p50_ms", "ms"),
    "p99_itl_ms": ("itl_p99_ms", "ms"),
    "median_tpot_ms": ("tpot_p50_ms", "ms"),
    "p99_tpot_ms": ("tpot_p99_ms", "ms"),
}

# Tag written for each counter of a serving-benchmark document.
SERVING_COUNTER_TAGS = {
    "completed": "completed_requests",
    "total_input_tokens": "total_input_tokens",
    "total_output_tokens": "total_output_tokens",
}

# Leading text of a model name -> replacement, applied in this order.
MODEL_PREFIX_RULES = [
    ("mlx-community/", ""),
    ("openrouter/openai/", "openrouter/"),
]

SYSTEM_FIELDS = [
    ("os", "string"),
    ("chip", "string"),
    ("memory_gb", "integer"),
    ("vllm_mlx_version", "string"),
    ("runner", "string"),
    ("python_version", "string"),
    ("mlx_version", "string"),
    ("mlx_lm_version", "string"),
    ("lm_eval_version", "string"),
    ("kernel", "string"),
]
# --- end of fixed values ---------------------------------------------------------------------------

_DDL = {"string": "STRING", "integer": "BIGINT", "number": "DOUBLE", "boolean": "BOOLEAN"}

SYSTEM_DDL = "STRUCT<" + ", ".join(f"{n}: {_DDL[t]}" for n, t in SYSTEM_FIELDS) + ">"
GEN_KWARGS_DDL = "STRUCT<max_gen_toks: BIGINT, temperature: DOUBLE, top_p: DOUBLE, top_k: BIGINT>"
RESULT_DDL = (
    "STRUCT<name: STRING, metric: STRING, value: DOUBLE, unit: STRING, duration_seconds: DOUBLE, "
    "tags: MAP<STRING, STRING>, raw: VARIANT>"
)
SNAPSHOT_DDL = "STRUCT<phase: STRING, rss_gb: DOUBLE, free_gb: DOUBLE, wired_gb: DOUBLE, swap_mb: DOUBLE>"

ENVELOPE_DDL = f"""
schema_version STRING, timestamp STRING, git_sha STRING, trigger STRING, pr_number BIGINT, suite STRING,
model STRING, model_revision STRING, quantization STRING, skipped BOOLEAN, seed BIGINT,
gen_kwargs {GEN_KWARGS_DDL}, system {SYSTEM_DDL}, results ARRAY<{RESULT_DDL}>,
memory_snapshots ARRAY<{SNAPSHOT_DDL}>, errors ARRAY<STRING>
"""
ENVELOPE_COLUMNS = [
    "schema_version", "timestamp", "git_sha", "trigger", "pr_number", "suite", "model", "model_revision",
    "quantization", "skipped", "seed", "gen_kwargs", "system", "results", "memory_snapshots", "errors",
]

# Flat rows as stored: one row per measurement, tags kept as a map.
FLAT_DDL = """
schema_version STRING, timestamp TIMESTAMP, git_sha STRING, trigger STRING, suite STRING, model STRING,
os STRING, chip STRING, memory_gb BIGINT, model_revision STRING, quantization STRING, seed BIGINT,
name STRING, metric STRING, value DOUBLE, unit STRING, duration_seconds DOUBLE,
tags MAP<STRING, STRING>, shard_key STRING, content_sha STRING
"""

# The columns every result query may rely on, for a dataset that has no shards yet.
RESULT_COLUMNS_DDL = (
    "timestamp TIMESTAMP, suite STRING, name STRING, metric STRING, model STRING, value DOUBLE, model_short STRING"
)


def flat_schema(tag_keys: list[str] | None = None, timestamp_type: str = "TIMESTAMP") -> T.StructType:
    """Schema of flat rows. ``tag_keys`` switches to one ``tag_<key>`` column per key."""
    ddl = FLAT_DDL.replace("timestamp TIMESTAMP", f"timestamp {timestamp_type}")
    if tag_keys is not None:
        cols = "".join(f"`tag_{k}` STRING, " for k in tag_keys)
        ddl = ddl.replace("tags MAP<STRING, STRING>, ", cols)
    return T.StructType.fromDDL(ddl)
