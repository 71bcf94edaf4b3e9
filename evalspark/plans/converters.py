"""Queries over raw documents: each converter step, and whole conversions."""

from __future__ import annotations

from pyspark.sql import functions as F

from evalspark.functions import variants as V
from evalspark.functions.maps import sorted_entries
from evalspark.operators import convert as C
from evalspark.operators import flatten as FL
from evalspark.operators import results as Q
from evalspark.operators import serving, task_eval
from evalspark.plans.bindings import (
    EPOCH_TEXT_SQL,
    EV_SQL,
    MEASUREMENTS_SQL,
    MODEL_SQL,
    READABLE,
    SERVING_SQL,
    SHA_SQL,
    ingest_time,
    raw_serving_documents,
    raw_task_documents,
    run_context,
    table,
)
from evalspark.plans.registry import query
from evalspark.sources.raw import parse_documents, split_parsed
from evalspark.sources.shards import with_derived


def documents(spark, sf_dir):
    """Readable task documents, opened."""
    return split_parsed(parse_documents(raw_task_documents(spark, sf_dir)))[0]


def opened(spark, sf_dir):
    return task_eval.open_document(documents(spark, sf_dir))


def tag_text(m) -> F.Column:
    """A map as ``k=v;k=v`` in key order."""
    return F.array_join(F.transform(sorted_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")

_RAW_ENTRIES = """
SELECT id, task, x.k AS metric_key, x.t AS val_text FROM (
  SELECT id, ty AS task, unnest([
    {'k': 'alias', 't': ty},
    {'k': 'exact_match,flexible-extract', 't': 'number'}, {'k': 'exact_match_stderr,flexible-extract', 't': 'number'},
    {'k': 'exact_match,strict-match', 't': 'number'}, {'k': 'acc,none', 't': '0.5'}, {'k': 'passed', 't': 'boolean'},
    {'k': 'f1,macro', 't': CASE WHEN id % 3 = 0 THEN NULL ELSE 'number' END}]) AS x
  FROM docs WHERE id % 17 <> 0
  UNION ALL
  SELECT id, 't.' || CAST(k % 7 AS VARCHAR) || '/x' AS task, unnest([
    {'k': 'alias', 't': 't'}, {'k': 'acc_norm,none', 't': 'number'}, {'k': 'wait_ms', 't': 'number'},
    {'k': 'setup_seconds', 't': 'number'}, {'k': 'load_seconds,none', 't': 'number'}, {'k': 'pass@1,none', 't': 'number'}]) AS x
  FROM docs WHERE id % 17 <> 0
) WHERE x.t IS NOT NULL"""


@query("c1_explode_task_metrics", f"WITH {EV_SQL} {_RAW_ENTRIES}")
def c1_explode_task_metrics(spark, sf_dir):
    rows = task_eval.explode_task_metrics(documents(spark, sf_dir).select("id", "doc"))
    v = F.col("metric_value")
    shown = F.when(V.is_number(v), "number").when(V.is_boolean(v), "boolean").otherwise(V.string(v))
    return rows.select("id", "task", "metric_key", shown.alias("val_text"))


def _measured(spark, sf_dir):
    rows = task_eval.explode_task_metrics(documents(spark, sf_dir).select("id", "doc"))
    return rows.where(task_eval.is_measurement(F.col("metric_key"), F.col("metric_value")))


@query(
    "c2_keep_numeric_metrics",
    f"WITH {EV_SQL}, {MEASUREMENTS_SQL} SELECT id, task, metric_key, val AS value FROM mm",
)
def c2_keep_numeric_metrics(spark, sf_dir):
    return _measured(spark, sf_dir).select(
        "id", "task", "metric_key", V.numeric_or_bool(F.col("metric_value")).alias("value")
    )


@query("c3_rename_metric", f"WITH {EV_SQL}, {MEASUREMENTS_SQL} SELECT id, task, metric_key, metric FROM mm")
def c3_rename_metric(spark, sf_dir):
    rows = _measured(spark, sf_dir)
    return rows.select("id", "task", "metric_key", task_eval.rename_metric(F.col("metric_key")).alias("metric"))


@query(
    "c4_infer_unit", f"WITH {EV_SQL}, {MEASUREMENTS_SQL} SELECT metric, unit, count(*) AS n FROM mm GROUP BY metric, unit"
)
def c4_infer_unit(spark, sf_dir):
    metric = task_eval.rename_metric(F.col("metric_key"))
    rows = _measured(spark, sf_dir).select(metric.alias("metric"))
    return rows.groupBy("metric", task_eval.infer_unit(F.col("metric")).alias("unit")).agg(F.count(F.lit(1)).alias("n"))

# Tags in key order. A config that is text has neither limit nor token budget.
_TAGS_SQL = """concat_ws(';',
  'lm_eval_key=' || metric_key,
  CASE WHEN id % 23 <> 7 THEN CASE id % 6 WHEN 2 THEN 'max_gen_toks=4096' WHEN 3 THEN 'max_gen_toks=4096'
       WHEN 4 THEN 'max_gen_toks=' || CAST(k AS VARCHAR) END END,
  'n_limit=' || CASE WHEN id % 4 = 0 OR id % 23 = 7 THEN '999' ELSE CAST(k AS VARCHAR) END,
  'team=t' || CAST(u % 3 AS VARCHAR),
  CASE id % 4 WHEN 0 THEN 'total_eval_time_s=123.45' WHEN 1 THEN 'total_eval_time_s=' || CAST(k AS VARCHAR)
              WHEN 2 THEN 'total_eval_time_s=100.0' END)"""


@query(
    "c5_build_tags", f"WITH {EV_SQL}, {MEASUREMENTS_SQL} SELECT id, task, metric_key, {_TAGS_SQL} AS tags FROM mm"
)
def c5_build_tags(spark, sf_dir):
    docs = run_context(opened(spark, sf_dir))
    tags = task_eval.run_tags(F.col("extra_tags"), F.col("_top"), F.col("_cfg"), F.col("_gen"))
    rows = task_eval.explode_task_metrics(docs.withColumn("_tags", tags).select("id", "doc", "_tags"))
    rows = rows.where(task_eval.is_measurement(F.col("metric_key"), F.col("metric_value")))
    merged = task_eval.measurement_tags(F.col("metric_key"), F.col("_tags"))
    return rows.select("id", "task", "metric_key", tag_text(merged).alias("tags"))

_SECONDS_SQL = "CASE WHEN task = ty THEN CASE id % 5 WHEN 2 THEN 0.0 WHEN 3 THEN v WHEN 4 THEN v END END"


@query(
    "c6_task_duration",
    f"""WITH {EV_SQL}, {MEASUREMENTS_SQL}
        SELECT DISTINCT id, task, CAST({_SECONDS_SQL} AS DOUBLE) AS duration_seconds FROM mm""",
)
def c6_task_duration(spark, sf_dir):
    tasks = opened(spark, sf_dir).select("id", "_took", F.explode_outer(V.fields(F.col("_top")["results"])).alias("task", "_m"))
    seconds = task_eval.task_duration(F.col("_took"), F.col("task"))
    return tasks.where("task IS NOT NULL").select("id", "task", seconds.alias("duration_seconds"))


@query("c7_extract_timestamp", f"WITH {EV_SQL} SELECT id, {EPOCH_TEXT_SQL} AS timestamp FROM docs")
def c7_extract_timestamp(spark, sf_dir):
    docs = opened(spark, sf_dir)
    no_override = F.lit(None).cast("string")
    return docs.select(
        "id", task_eval.extract_timestamp(no_override, F.col("_top")["date"], ingest_time()).alias("timestamp")
    )

_GEN_SQL = """
CAST(CASE WHEN ok THEN CASE id % 6 WHEN 2 THEN 4096 WHEN 4 THEN k END END AS BIGINT) AS max_gen_toks,
CAST(CASE WHEN ok AND id % 6 = 2 THEN 0 END AS DOUBLE) AS temperature,
CAST(CASE WHEN ok THEN CASE id % 6 WHEN 3 THEN 1 WHEN 4 THEN 0.95 END END AS DOUBLE) AS top_p,
CAST(CASE WHEN ok AND id % 6 = 4 THEN 40 END AS BIGINT) AS top_k"""


@query(
    "c8_extract_gen_kwargs",
    f"""WITH {EV_SQL} SELECT id, ok AND id % 6 IN (2, 3, 4) AS present, {_GEN_SQL}
        FROM (SELECT *, {READABLE} AS ok FROM docs)""",
)
def c8_extract_gen_kwargs(spark, sf_dir):
    docs = opened(spark, sf_dir).select("id", task_eval.extract_gen_kwargs(F.col("_gen")).alias("g"))
    return docs.select("id", F.col("g").isNotNull().alias("present"), "g.*")


@query(
    "c9_extract_seed",
    f"WITH {EV_SQL} SELECT id, CAST(CASE WHEN {READABLE} AND id % 3 = 1 THEN k END AS BIGINT) AS seed FROM docs",
)
def c9_extract_seed(spark, sf_dir):
    return opened(spark, sf_dir).select("id", task_eval.extract_seed(F.col("_cfg")).alias("seed"))

_REVISION_SQL = f"""CASE WHEN id % 7 = 0 THEN 'src-' || CAST(k AS VARCHAR)
  WHEN {READABLE} AND id % 5 = 0 THEN 'rev' || CAST(k AS VARCHAR) END"""


@query("c10_extract_revision", f"WITH {EV_SQL} SELECT id, {_REVISION_SQL} AS model_revision FROM docs")
def c10_extract_revision(spark, sf_dir):
    revision = task_eval.extract_revision(F.col("_top"), F.col("_args"))
    return opened(spark, sf_dir).select("id", revision.alias("model_revision"))


@query(
    "c11_unpivot_serving_metrics",
    f"WITH {EV_SQL}, {SERVING_SQL} SELECT id, 'benchmark_serving' AS name, metric, val AS value, unit FROM sv",
)
def c11_unpivot_serving_metrics(spark, sf_dir):
    return serving.unpivot_serving_metrics(parse_documents(raw_serving_documents(spark, sf_dir)), ["id"])


@query(
    "c12_build_tags",
    f"""WITH {EV_SQL} SELECT id, concat_ws(';', 'completed_requests=' || CAST(k AS VARCHAR), 'n_limit=999',
          'team=t' || CAST(u % 3 AS VARCHAR), 'total_input_tokens=' || CAST(k * 10 AS VARCHAR),
          CASE WHEN id % 5 <> 0 THEN 'total_output_tokens=' || CAST(k * 20 AS VARCHAR) END) AS tags FROM ev""",
)
def c12_build_tags(spark, sf_dir):
    docs = task_eval.open_document(run_context(parse_documents(raw_serving_documents(spark, sf_dir))))
    return docs.select("id", tag_text(serving.serving_tags(F.col("extra_tags"), F.col("_top"))).alias("tags"))


@query(
    "c13_serving_duration",
    f"WITH {EV_SQL} SELECT id, CAST(CASE WHEN id % 9 <> 0 THEN v END AS DOUBLE) AS duration_seconds FROM ev",
)
def c13_serving_duration(spark, sf_dir):
    docs = task_eval.open_document(parse_documents(raw_serving_documents(spark, sf_dir)))
    return docs.select("id", serving.serving_duration(F.col("_top")).alias("duration_seconds"))


def task_envelopes(spark, sf_dir):
    """``(envelopes, rejects)`` of all task documents, runs with their context."""
    docs = C.fill_run_context(run_context(parse_documents(raw_task_documents(spark, sf_dir))))
    return C.split_converted(C.convert(docs, "lm-eval", ["id"], ingest_time()), ["id"])


@query(
    "c14_assemble_envelopes",
    f"""WITH {EV_SQL}, {MEASUREMENTS_SQL},
        per AS (SELECT id, count(*) AS n, string_agg(metric, ',' ORDER BY metric) AS metrics, max(val) AS top_value FROM mm GROUP BY id)
        SELECT d.id, '1' AS schema_version, {EPOCH_TEXT_SQL.replace("id %", "d.id %").replace("(ts", "(d.ts")} AS timestamp,
          lpad(CAST(d.id AS VARCHAR), 8, '0') AS git_sha, 'local' AS trigger, CAST(NULL AS BIGINT) AS pr_number,
          d.suite, CAST(CASE WHEN d.id % 3 = 1 THEN d.k END AS BIGINT) AS seed,
          CAST(128 AS BIGINT) AS memory_gb, CAST(coalesce(n, 0) AS BIGINT) AS n_results, coalesce(metrics, '') AS metrics,
          top_value, CAST(0 AS BIGINT) AS n_errors
        FROM docs d LEFT JOIN per USING (id) WHERE d.{READABLE}""",
)
def c14_assemble_envelopes(spark, sf_dir):
    e = task_envelopes(spark, sf_dir)[0]
    metrics = F.array_join(F.array_sort(F.transform("results", lambda r: r["metric"])), ",")
    return e.select(
        "id",
        "schema_version",
        "timestamp",
        "git_sha",
        "trigger",
        "pr_number",
        "suite",
        "seed",
        F.col("system.memory_gb").alias("memory_gb"),
        F.size("results").cast("bigint").alias("n_results"),
        metrics.alias("metrics"),
        F.array_max(F.transform("results", lambda r: r["value"])).alias("top_value"),
        F.size("errors").cast("bigint").alias("n_errors"),
    )


@query("c15_resolve_model", f"WITH {EV_SQL} SELECT id, {MODEL_SQL} AS model FROM docs")
def c15_resolve_model(spark, sf_dir):
    no_override = F.lit(None).cast("string")
    model = task_eval.resolve_model(no_override, F.col("_top"), F.col("_args"))
    return opened(spark, sf_dir).select("id", model.alias("model"))

_TAG_KINDS = "CASE c_custkey % 4 WHEN 0 THEN 'noequals' WHEN 1 THEN '=x' ELSE concat('seg=', c_mktsegment, '=', c_nationkey) END"


def _tag_pairs(spark, sf_dir):
    pairs = f"array('team=a', {_TAG_KINDS}, concat('team=', c_nationkey), 'empty=')"
    return C.parse_tag_pairs(table(spark, sf_dir, "customer").selectExpr("c_custkey", f"{pairs} AS pairs"), "pairs", ["c_custkey"])


@query(
    "c16_parse_tag_pairs",
    """SELECT c_custkey, 'empty=;seg=' || c_mktsegment || '=' || CAST(c_nationkey AS VARCHAR) || ';team=' || CAST(c_nationkey AS VARCHAR) AS tags
       FROM customer WHERE c_custkey % 4 > 1""",
)
def c16_parse_tag_pairs(spark, sf_dir):
    return _tag_pairs(spark, sf_dir)[0].select("c_custkey", tag_text(F.col("tags")).alias("tags"))


@query(
    "c16_parse_tag_pairs_rejects",
    """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'noequals' ELSE '=x' END AS pair,
         CASE c_custkey % 4 WHEN 0 THEN 'expected KEY=VALUE' ELSE 'empty key' END AS reason
       FROM customer WHERE c_custkey % 4 < 2""",
)
def c16_parse_tag_pairs_rejects(spark, sf_dir):
    return _tag_pairs(spark, sf_dir)[1]


@query(
    "c17_convert",
    f"""WITH {EV_SQL}, {MEASUREMENTS_SQL}, {SERVING_SQL}
        SELECT id, 'lm-eval' AS kind, task AS name, metric, val AS value FROM mm WHERE {READABLE}
        UNION ALL SELECT id, 'vllm' AS kind, 'benchmark_serving' AS name, metric, val AS value FROM sv""",
)
def c17_convert(spark, sf_dir):
    """Documents of both tools in one input; they share one pass."""
    tasks = raw_task_documents(spark, sf_dir).withColumn("kind", F.lit("lm-eval"))
    serving_docs = raw_serving_documents(spark, sf_dir).withColumn("kind", F.lit("vllm"))
    both = parse_documents(tasks.unionByName(serving_docs))
    done = C.convert(C.fill_run_context(run_context(both)), F.col("kind"), ["id", "kind"], ingest_time(), ["results"], with_tags=False)
    good = C.split_converted(done, ["id", "kind"])[0]
    return FL.flatten(good, ["id", "kind"]).select("id", "kind", "name", "metric", "value")


@query(
    "c17_convert_rejects",
    f"""WITH {EV_SQL}
        SELECT id, CASE id % 2 WHEN 1 THEN 'csv' ELSE 'lm-eval' END AS kind,
          CASE WHEN id % 2 = 1 THEN 'unknown converter kind: csv'
               WHEN id % 13 = 12 THEN 'not valid JSON' ELSE 'config is not an object' END AS reason
        FROM ev WHERE id % 2 = 1 OR id % 13 = 12 OR id % 23 = 7""",
)
def c17_convert_rejects(spark, sf_dir):
    docs = parse_documents(raw_task_documents(spark, sf_dir)).withColumn("kind", F.expr("IF(id % 2 = 1, 'csv', 'lm-eval')"))
    done = C.convert(C.fill_run_context(run_context(docs)), F.col("kind"), ["id", "kind"], ingest_time())
    return C.split_converted(done, ["id", "kind"])[1]


@query(
    "c18_fill_run_context",
    f"""WITH {EV_SQL} SELECT id, CASE WHEN c_custkey IS NULL OR c_custkey % 3 = 0 THEN 'local' ELSE 'schedule' END AS trigger,
          CASE WHEN c_custkey IS NULL OR c_custkey % 2 = 0 THEN 'unknown' ELSE lpad(CAST(c_custkey AS VARCHAR), 7, '0') END AS git_sha,
          c_mktsegment AS chip
        FROM docs LEFT JOIN customer ON c_custkey = u AND c_mktsegment <> 'MACHINERY'""",
)
def c18_fill_run_context(spark, sf_dir):
    docs = documents(spark, sf_dir).withColumn("run_id", F.col("u")).drop("suite")
    runs = table(spark, sf_dir, "customer").where("c_mktsegment <> 'MACHINERY'").selectExpr(
        "c_custkey AS run_id",
        "IF(c_custkey % 3 = 0, NULL, 'schedule') AS trigger",
        "IF(c_custkey % 2 = 0, NULL, lpad(CAST(c_custkey AS STRING), 7, '0')) AS git_sha",
        "named_struct('os', 'os-1', 'chip', c_mktsegment, 'memory_gb', 64L) AS system",
    )
    return C.fill_run_context(docs, runs).select("id", "trigger", "git_sha", F.col("system.chip").alias("chip"))


@query(
    "f1_flatten",
    f"""WITH {EV_SQL}, {MEASUREMENTS_SQL}
        SELECT id, '1' AS schema_version, {EPOCH_TEXT_SQL} AS timestamp, {SHA_SQL} AS git_sha, 'local' AS trigger, suite,
          {MODEL_SQL} AS model, 'os-1' AS os, 'chip-1' AS chip, CAST(128 AS BIGINT) AS memory_gb,
          {_REVISION_SQL} AS model_revision, CAST(NULL AS VARCHAR) AS quantization,
          CAST(CASE WHEN id % 3 = 1 THEN k END AS BIGINT) AS seed, task AS name, metric, val AS value, unit,
          CAST({_SECONDS_SQL} AS DOUBLE) AS duration_seconds, {_TAGS_SQL} AS tags
        FROM mm WHERE {READABLE}""",
)
def f1_flatten(spark, sf_dir):
    """Raw documents to flat rows: the whole way, one narrow job."""
    rows = FL.flatten(task_envelopes(spark, sf_dir)[0], ["id"])
    return rows.withColumn("tags", tag_text(F.col("tags")))


@query(
    "flagship_leaderboard",
    f"""WITH {EV_SQL}, {MEASUREMENTS_SQL},
        scored AS (
          SELECT {MODEL_SQL} AS model, val AS value, git, run_at FROM (
            SELECT *, {SHA_SQL} AS git, {EPOCH_TEXT_SQL} AS run_at FROM mm
            WHERE {READABLE} AND suite = 'reasoning' AND task = 'view' AND metric = 'exact_match_flexible')),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY run_at DESC, git DESC) AS n FROM scored)
        SELECT model, model AS label, value FROM ranked WHERE n = 1""",
)
def flagship_leaderboard(spark, sf_dir):
    """Raw text to the latest score of every model: parse, convert, flatten, select, reduce, sort."""
    # Only documents of the suite are parsed: the suite is known from the run's context.
    raw = raw_task_documents(spark, sf_dir).where("suite = 'reasoning'")
    docs = C.fill_run_context(run_context(parse_documents(raw)))
    columns = ["timestamp", "git_sha", "suite", "model", "results"]
    done = C.convert(docs, "lm-eval", [], ingest_time(), columns, with_tags=False)
    rows = with_derived(FL.flatten(C.split_converted(done, [])[0]).withColumn("shard_key", F.col("git_sha")))
    return Q.leaderboard(rows, "reasoning", "view", "exact_match_flexible").drop("timestamp")
