"""The driver's tables in the shapes the operators read, and the same shapes as SQL for the checks.

Every binding is a narrow step: one table row gives one run, document, envelope or message. Nothing is grouped to
make a document, so no key of the source tables can gather its rows in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUITE_OF_EVENT = {
    "view": "reasoning",
    "click": "coding",
    "purchase": "knowledge",
    "signup": "throughput",
    "error": "math-hard",
}
METRICS = ["exact_match_flexible", "exact_match_strict", "accuracy"]
INGEST_TIME = "2025-01-01 00:00:00"
STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"

_SUITE_CASE = (
    "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SUITE_OF_EVENT.items()) + " ELSE 'evalplus' END"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


INPUT_PARTITIONS = "spark.evalspark.input.partitions"
# A document of a table row is some hundred times the work that its bytes in the table suggest.
ROWS_PER_TASK = 50_000


def spread(df: DataFrame) -> DataFrame:
    """Rows of a source dealt to tasks by their number, which readers, who split by bytes and row groups, do not look at.

    The number comes from the footers of the files; a source of up to ``ROWS_PER_TASK`` rows is taken as it comes. The
    session's ``INPUT_PARTITIONS`` states a number of partitions instead.
    """
    wanted = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    parts = int(wanted) if wanted else math.ceil(df.count() / ROWS_PER_TASK)
    return df.repartition(parts) if wanted or parts > 1 else df


def stamp_text(column: str = "timestamp"):
    return F.date_format(column, STAMP)


# --- flat results ----------------------------------------------------------------------------------

B1_SQL = f"""
b1 AS (
  SELECT event_id,
         CASE WHEN event_id % 997 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS ts_text,
         CASE WHEN event_id % 101 = 0 THEN NULL ELSE
           CASE user_id % 3 WHEN 0 THEN 'mlx-community/' WHEN 1 THEN 'openrouter/openai/' ELSE '' END
           || 'model-' || CAST(user_id % 12 AS VARCHAR) END AS model,
         CASE WHEN event_id % 101 = 0 THEN NULL ELSE
           CASE user_id % 3 WHEN 1 THEN 'openrouter/' ELSE '' END
           || 'model-' || CAST(user_id % 12 AS VARCHAR) END AS model_short,
         {_SUITE_CASE} AS suite,
         'task_' || CAST(event_id % 5 AS VARCHAR) AS name,
         CASE event_id % 3 WHEN 0 THEN '{METRICS[0]}' WHEN 1 THEN '{METRICS[1]}' ELSE '{METRICS[2]}' END AS metric,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS value,
         regexp_extract(props, '([0-9]+)', 1) AS k,
         'shard-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS shard_key
  FROM events
)"""


def flat_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows (tags as a map), one per event."""
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    prefix = F.when(F.col("user_id") % 3 == 0, "mlx-community/").when(F.col("user_id") % 3 == 1, "openrouter/openai/")
    model = F.concat(prefix.otherwise(""), F.lit("model-"), (F.col("user_id") % 12).cast("string"))
    return e.select(
        F.lit("1").alias("schema_version"),
        F.when(eid % 997 != 0, F.col("ts").cast("timestamp")).alias("timestamp"),
        F.lpad(eid.cast("string"), 8, "0").alias("git_sha"),
        F.lit("local").alias("trigger"),
        F.expr(_SUITE_CASE).alias("suite"),
        F.when(eid % 101 != 0, model).alias("model"),
        F.lit("os-1").alias("os"),
        F.lit("chip-1").alias("chip"),
        F.lit(128).cast("bigint").alias("memory_gb"),
        F.lit(None).cast("string").alias("model_revision"),
        F.lit(None).cast("string").alias("quantization"),
        F.when(eid % 2 == 0, eid).alias("seed"),
        F.concat(F.lit("task_"), (eid % 5).cast("string")).alias("name"),
        F.when(eid % 3 == 0, METRICS[0]).when(eid % 3 == 1, METRICS[1]).otherwise(METRICS[2]).alias("metric"),
        F.when(eid % 11 != 0, F.col("value")).alias("value"),
        F.lit("ratio").alias("unit"),
        F.lit(None).cast("double").alias("duration_seconds"),
        F.create_map(F.lit("k"), F.regexp_extract("props", "([0-9]+)", 1)).alias("tags"),
        F.concat(F.lit("shard-"), F.lpad(eid.cast("string"), 12, "0")).alias("shard_key"),
    )


# --- raw task-evaluation documents -----------------------------------------------------------------

EV_SQL = f"""
ev AS (
  SELECT event_id AS id, user_id AS u, event_type AS ty, value AS v, ts,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, {_SUITE_CASE} AS suite
  FROM events
),
docs AS (SELECT * FROM ev WHERE id % 13 <> 12)"""


def _event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "events")).selectExpr(
        "event_id AS id",
        "user_id AS u",
        "event_type AS ty",
        "value AS v",
        "ts",
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k",
        f"{_SUITE_CASE} AS suite",
    )


_TASK_FIELDS = [
    ("alias", "string"),
    ("exact_match,flexible-extract", "double"),
    ("exact_match_stderr,flexible-extract", "double"),
    ("exact_match,strict-match", "bigint"),
    ("acc,none", "string"),
    ("passed", "boolean"),
    ("f1,macro", "double"),
    ("acc_norm,none", "double"),
    ("wait_ms", "bigint"),
    ("setup_seconds", "double"),
    ("load_seconds,none", "double"),
    ("pass@1,none", "bigint"),
]


def _task_object(**known: str) -> str:
    values = [f"'{n}', CAST({known.get(n, 'NULL')} AS {t})" for n, t in _TASK_FIELDS]
    return f"named_struct({', '.join(values)})"


_FIRST_TASK = _task_object(
    **{
        "alias": "ty",
        "exact_match,flexible-extract": "v",
        "exact_match_stderr,flexible-extract": "0.145",
        "exact_match,strict-match": "k",
        "acc,none": "'0.5'",
        "passed": "id % 2 = 0",
        "f1,macro": "IF(id % 3 = 0, NULL, 0.25)",
    }
)
_SECOND_TASK = _task_object(
    **{
        "alias": "'t'",
        "acc_norm,none": "v",
        "wait_ms": "k * 10",
        "setup_seconds": "v",
        "load_seconds,none": "1.5",
        "pass@1,none": "k % 2",
    }
)
_RESULTS = f"""IF(id % 17 = 0, 'null',
  to_json(map(ty, {_FIRST_TASK}, concat('t.', k % 7, '/x'), {_SECOND_TASK})))"""
_GEN_KWARGS = """CASE id % 6
  WHEN 0 THEN 'null'
  WHEN 1 THEN '{}'
  WHEN 2 THEN '{"max_gen_toks": 4096, "temperature": 0.0}'
  WHEN 3 THEN '{"max_gen_toks": "4096", "temperature": "hot", "top_p": 1, "top_k": 4.5}'
  WHEN 4 THEN concat('{"max_gen_toks": ', k, ', "top_k": 40, "top_p": 0.95}')
  ELSE '{"note": "x"}' END"""
_CONFIG = f"""IF(id % 23 = 7, '"default"', concat(
  '{{"model_args": {{"model": "args-model-', u % 12, '", "revision": ', IF(id % 5 = 0, concat('"rev', k, '"'), 'null'), '}}',
  ', "limit": ', IF(id % 4 = 0, 'null', CAST(k AS STRING)),
  ', "gen_kwargs": ', {_GEN_KWARGS},
  CASE id % 3 WHEN 0 THEN concat(', "seed": [', k, ', ', k, ']') WHEN 1 THEN concat(', "seed": ', k) ELSE '' END,
  '}}'))"""
_TASK_DOCUMENT = f"""concat(
  '{{"results": ', {_RESULTS},
  ', "config": ', {_CONFIG},
  CASE id % 4 WHEN 0 THEN '' WHEN 1 THEN ', "model_name": ""' ELSE concat(', "model_name": "named-', u % 7, '"') END,
  ', "model": "raw-model"',
  CASE id % 4
    WHEN 0 THEN concat(', "date": ', CAST(unix_micros(CAST(ts AS TIMESTAMP)) / CAST(1000000 AS DECIMAL(10,0)) AS DECIMAL(20,6)))
    WHEN 1 THEN concat(', "date": "', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"), '"')
    WHEN 2 THEN ', "date": "2024-01-01 10:00"'
    ELSE '' END,
  CASE id % 4
    WHEN 0 THEN ', "total_evaluation_time_seconds": "123.45"'
    WHEN 1 THEN concat(', "total_evaluation_time_seconds": ', k)
    WHEN 2 THEN ', "total_evaluation_time_seconds": 100.0'
    ELSE '' END,
  CASE id % 5
    WHEN 0 THEN concat(', "total_evaluation_time_seconds_per_task": {{"', ty, '": "slow"}}')
    WHEN 1 THEN ''
    WHEN 2 THEN concat(', "total_evaluation_time_seconds_per_task": {{"', ty, '": 0}}')
    ELSE concat(', "total_evaluation_time_seconds_per_task": {{"', ty, '": ', v, '}}') END,
  CASE id % 7 WHEN 0 THEN concat(', "model_source": "src-', k, '"') WHEN 1 THEN ', "model_source": ""' ELSE '' END,
  '}}')"""


def raw_task_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, suite, raw``: one document per event, every 13th cut off."""
    return _event_rows(spark, sf_dir).selectExpr(
        "id",
        "u",
        "suite",
        f"CASE WHEN id % 13 = 12 THEN left({_TASK_DOCUMENT}, 40) ELSE {_TASK_DOCUMENT} END AS raw",
    )


# What the measurements of a document must be: straight from the table, not through any document.
MEASUREMENTS_SQL = """
m AS (
  SELECT *, unnest([
    {'task': ty, 'metric_key': 'exact_match,flexible-extract', 'metric': 'exact_match_flexible', 'val': v, 'unit': 'ratio'},
    {'task': ty, 'metric_key': 'exact_match,strict-match', 'metric': 'exact_match_strict', 'val': CAST(k AS DOUBLE), 'unit': 'ratio'},
    {'task': ty, 'metric_key': 'passed', 'metric': 'passed', 'val': CASE WHEN id % 2 = 0 THEN 1.0 ELSE 0.0 END, 'unit': 'ratio'},
    {'task': ty, 'metric_key': 'f1,macro', 'metric': 'f1_macro', 'val': CASE WHEN id % 3 = 0 THEN NULL ELSE 0.25 END, 'unit': 'ratio'},
    {'task': 't.' || CAST(k % 7 AS VARCHAR) || '/x', 'metric_key': 'acc_norm,none', 'metric': 'accuracy_normalized', 'val': v, 'unit': 'ratio'},
    {'task': 't.' || CAST(k % 7 AS VARCHAR) || '/x', 'metric_key': 'wait_ms', 'metric': 'wait_ms', 'val': CAST(k * 10 AS DOUBLE), 'unit': 'ms'},
    {'task': 't.' || CAST(k % 7 AS VARCHAR) || '/x', 'metric_key': 'setup_seconds', 'metric': 'setup_seconds', 'val': v, 'unit': 'seconds'},
    {'task': 't.' || CAST(k % 7 AS VARCHAR) || '/x', 'metric_key': 'load_seconds,none', 'metric': 'load_seconds_none', 'val': 1.5, 'unit': 'ratio'},
    {'task': 't.' || CAST(k % 7 AS VARCHAR) || '/x', 'metric_key': 'pass@1,none', 'metric': 'pass_at_1', 'val': CAST(k % 2 AS DOUBLE), 'unit': 'ratio'}
  ]) AS x
  FROM docs WHERE id % 17 <> 0
),
mm AS (
  SELECT id, u, ty, v, k, ts, suite, x.task AS task, x.metric_key AS metric_key, x.metric AS metric,
         CAST(x.val AS DOUBLE) AS val, x.unit AS unit
  FROM m WHERE x.val IS NOT NULL
)"""

# A config that is text makes a document unreadable for its converter; the rest is published.
READABLE = "id % 23 <> 7"
EPOCH_TEXT_SQL = f"""CASE id % 4
  WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
  WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
  ELSE '{INGEST_TIME.replace(" ", "T")}Z' END"""
SHA_SQL = "lpad(CAST(id AS VARCHAR), 8, '0')"
MODEL_SQL = """CASE WHEN id % 4 IN (0, 1) THEN
  CASE WHEN id % 23 = 7 THEN 'raw-model' ELSE 'args-model-' || CAST(u % 12 AS VARCHAR) END
  ELSE 'named-' || CAST(u % 7 AS VARCHAR) END"""


def run_context(docs: DataFrame) -> DataFrame:
    """Context columns of the runs: revision, suite, tags, machine."""
    return docs.withColumns(
        {
            "git_sha": F.lpad(F.col("id").cast("string"), 8, "0"),
            "extra_tags": F.create_map(
                F.lit("n_limit"), F.lit("999"), F.lit("team"), F.concat(F.lit("t"), (F.col("u") % 3).cast("string"))
            ),
            "system": F.expr("named_struct('os', 'os-1', 'chip', 'chip-1', 'memory_gb', 128L)"),
        }
    )


def ingest_time():
    return F.lit(INGEST_TIME).cast("timestamp")


# --- raw serving documents -------------------------------------------------------------------------

_SERVING_DOCUMENT = """concat(
  '{"duration": ', IF(id % 9 = 0, '"slow"', CAST(v AS STRING)),
  ', "completed": ', IF(id % 4 = 0, concat(k, '.7'), CAST(k AS STRING)),
  ', "total_input_tokens": ', k * 10,
  ', "total_output_tokens": ', IF(id % 5 = 0, '"n/a"', CAST(k * 20 AS STRING)),
  ', "output_throughput": ', v,
  ', "total_token_throughput": ', k,
  IF(id % 3 = 0, '', ', "request_throughput": 1.5'),
  ', "mean_ttft_ms": 3.5',
  ', "median_ttft_ms": ', v,
  ', "p99_ttft_ms": ', IF(id % 2 = 0, '"x"', CAST(k AS STRING)),
  ', "median_itl_ms": ', IF(id % 2 = 0, 'true', 'false'),
  ', "p99_itl_ms": ', k,
  ', "median_tpot_ms": ', v,
  ', "p99_tpot_ms": null}')"""

SERVING_SQL = """
sm AS (
  SELECT *, unnest([
    {'metric': 'throughput_output_toks_per_s', 'val': v, 'unit': 'tok/s'},
    {'metric': 'throughput_total_toks_per_s', 'val': CAST(k AS DOUBLE), 'unit': 'tok/s'},
    {'metric': 'throughput_requests_per_s', 'val': CASE WHEN id % 3 = 0 THEN NULL ELSE 1.5 END, 'unit': 'req/s'},
    {'metric': 'ttft_p50_ms', 'val': v, 'unit': 'ms'},
    {'metric': 'ttft_p99_ms', 'val': CASE WHEN id % 2 = 0 THEN NULL ELSE CAST(k AS DOUBLE) END, 'unit': 'ms'},
    {'metric': 'itl_p50_ms', 'val': CASE WHEN id % 2 = 0 THEN 1.0 ELSE 0.0 END, 'unit': 'ms'},
    {'metric': 'itl_p99_ms', 'val': CAST(k AS DOUBLE), 'unit': 'ms'},
    {'metric': 'tpot_p50_ms', 'val': v, 'unit': 'ms'}
  ]) AS x
  FROM ev
),
sv AS (
  SELECT id, u, ty, v, k, ts, x.metric AS metric, CAST(x.val AS DOUBLE) AS val, x.unit AS unit FROM sm WHERE x.val IS NOT NULL
)"""


def raw_serving_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, u, suite, raw``: one document per event."""
    return _event_rows(spark, sf_dir).selectExpr("id", "u", "suite", f"{_SERVING_DOCUMENT} AS raw")


# --- envelopes from orders -------------------------------------------------------------------------

ORDER_SUITES = ["reasoning", "coding", "knowledge", "throughput", "math-hard"]
_ORDER_SUITE = (
    "CASE o_orderkey % 5 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(ORDER_SUITES)) + " END"
)
ORDER_SUITE_SQL = _ORDER_SUITE

ORDER_RESULTS_SQL = """
r AS (
  SELECT *, unnest(range(CAST(o_orderkey % 4 AS BIGINT))) AS i FROM orders
),
rr AS (
  SELECT *, 'line_' || CAST(i AS VARCHAR) AS name,
         CASE WHEN i = 1 THEN o_totalprice ELSE CAST(o_orderkey + i AS DOUBLE) END AS val,
         CAST(CASE WHEN i = 0 THEN 2.5 END AS DOUBLE) AS seconds
  FROM r
)"""


def order_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed envelopes, one per order, with zero to three measurements each."""
    return spread(table(spark, sf_dir, "orders")).selectExpr(
        "o_orderkey",
        "'1' AS schema_version",
        "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS timestamp",
        "lpad(CAST(o_orderkey AS STRING), 8, '0') AS git_sha",
        "'local' AS trigger",
        "CAST(NULL AS BIGINT) AS pr_number",
        f"{_ORDER_SUITE} AS suite",
        "concat('Org/Model_', o_custkey % 50, '.', o_orderpriority) AS model",
        "IF(o_orderkey % 2 = 0, 'rev', NULL) AS model_revision",
        "CAST(NULL AS STRING) AS quantization",
        "CAST(NULL AS BOOLEAN) AS skipped",
        "IF(o_orderkey % 3 = 0, o_orderkey, NULL) AS seed",
        "named_struct('os', 'os-1', 'chip', 'chip-1', 'memory_gb', CAST(o_orderkey % 9 AS BIGINT)) AS system",
        """transform(slice(sequence(0, 3), 1, CAST(o_orderkey % 4 AS INT)), i -> named_struct(
             'name', concat('line_', i), 'metric', 'price',
             'value', IF(i = 1, o_totalprice, CAST(o_orderkey + i AS DOUBLE)), 'unit', 'usd',
             'duration_seconds', IF(i = 0, CAST(2.5 AS DOUBLE), NULL),
             'tags', map('status', o_orderstatus, 'i', CAST(i AS STRING)))) AS results""",
    )
