"""Queries over flat results: scores, trends, pivot, facets."""

from __future__ import annotations

from pyspark.sql import functions as F

from evalspark.functions.names import score_label, short_model, slugify
from evalspark.operators import flatten as FL
from evalspark.operators import results as Q
from evalspark.plans.bindings import B1_SQL, flat_results, stamp_text, table
from evalspark.plans.registry import query
from evalspark.sources.shards import empty_results, with_derived

SUITE, TASK, METRIC = "reasoning", "task_1", "exact_match_flexible"
SELECTED = f"suite = '{SUITE}' AND name = '{TASK}' AND metric = '{METRIC}'"
PIVOT_NAMES = [f"task_{i}" for i in range(5)]

# Newest value that is not NULL, and newest time that is not NULL; a row without a time is newer than all others.
_NEWEST = "ts_text IS NULL DESC, ts_text DESC, shard_key DESC"


def _latest_sql(keys: str, where: str) -> str:
    return f"""
picked AS (
  SELECT *,
    row_number() OVER (PARTITION BY {keys} ORDER BY value IS NULL, {_NEWEST}) AS rv,
    row_number() OVER (PARTITION BY {keys} ORDER BY ts_text IS NULL, ts_text DESC, shard_key DESC) AS rt
  FROM b1 WHERE {where}
),
newest AS (
  SELECT {keys}, max(model_short) AS model_short, max(CASE WHEN rv = 1 THEN value END) AS value,
         max(CASE WHEN rt = 1 THEN ts_text END) AS ts_text
  FROM picked GROUP BY {keys}
)"""


def rows(spark, sf_dir):
    return with_derived(flat_results(spark, sf_dir))


@query(
    "f2_tags_to_columns",
    f"WITH {B1_SQL} SELECT shard_key, k AS tag_k, CAST(NULL AS VARCHAR) AS tag_absent, value FROM b1",
)
def f2_tags_to_columns(spark, sf_dir):
    wide = FL.tags_to_columns(flat_results(spark, sf_dir), ["k", "absent"])
    return wide.select("shard_key", "tag_k", "tag_absent", "value")


@query(
    "f3_slugify",
    """SELECT c_custkey, trim(lower(regexp_replace(c_mktsegment || '/' || c_name || '.', '[^a-zA-Z0-9-]', '-', 'g')), '-') AS slug
       FROM customer""",
)
def f3_slugify(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", slugify(F.concat("c_mktsegment", F.lit("/"), "c_name", F.lit("."))).alias("slug"))


@query(
    "q1_short_model", f"WITH {B1_SQL} SELECT model, model_short, count(*) AS n FROM b1 GROUP BY model, model_short"
)
def q1_short_model(spark, sf_dir):
    named = flat_results(spark, sf_dir).select("model", short_model(F.col("model")).alias("model_short"))
    return named.groupBy("model", "model_short").agg(F.count(F.lit(1)).alias("n"))


@query("q2_select_results", f"WITH {B1_SQL} SELECT model, value, ts_text, k FROM b1 WHERE {SELECTED}")
def q2_select_results(spark, sf_dir):
    chosen = Q.select_results(rows(spark, sf_dir), SUITE, TASK, METRIC)
    return chosen.select("model", "value", stamp_text().alias("ts_text"), F.col("tags")["k"].alias("k"))


_EVERY = "suite, name, metric, model"


@query(
    "q3_latest_by_model",
    f"WITH {B1_SQL}, {_latest_sql(_EVERY, 'model IS NOT NULL')} SELECT {_EVERY}, value, ts_text FROM newest",
)
def q3_latest_by_model(spark, sf_dir):
    """The newest score of every model, for all suites, tasks and metrics at once."""
    r = rows(spark, sf_dir).select("timestamp", "suite", "name", "metric", "model", "value", "shard_key")
    newest = Q.latest(r, ["suite", "name", "metric", "model"])
    return newest.select("suite", "name", "metric", "model", "value", stamp_text().alias("ts_text"))


@query(
    "q3_latest_by_model_row",
    f"""WITH {B1_SQL} SELECT suite, model, name, metric, value, ts_text, shard_key FROM (
          SELECT *, row_number() OVER (PARTITION BY suite, model ORDER BY {_NEWEST}) AS n FROM b1 WHERE model IS NOT NULL)
        WHERE n = 1""",
)
def q3_latest_by_model_row(spark, sf_dir):
    r = rows(spark, sf_dir).select("timestamp", "suite", "name", "metric", "model", "value", "shard_key")
    newest = Q.latest(r, ["suite", "model"], mode="row")
    return newest.select("suite", "model", "name", "metric", "value", stamp_text().alias("ts_text"), "shard_key")


@query(
    "q4_leaderboard",
    f"""WITH {B1_SQL}, {_latest_sql("model", SELECTED + " AND model IS NOT NULL")}
        SELECT model, model_short AS label, value, ts_text FROM newest""",
)
def q4_leaderboard(spark, sf_dir):
    board = Q.leaderboard(rows(spark, sf_dir), SUITE, TASK, METRIC)
    return board.select("model", "label", "value", stamp_text().alias("ts_text"))


@query(
    "q5_axis_max",
    f"""WITH {B1_SQL}, {_latest_sql("model", SELECTED + " AND model IS NOT NULL")}
        SELECT greatest(1.0, coalesce(max(value) * CAST(1.15 AS DOUBLE), 1.0)) AS axis_max FROM newest""",
)
def q5_axis_max(spark, sf_dir):
    return Q.axis_max(Q.leaderboard(rows(spark, sf_dir), SUITE, TASK, METRIC))


@query("q6_score_label", f"WITH {B1_SQL} SELECT shard_key, printf('%.3f', value) AS text FROM b1 WHERE value IS NOT NULL")
def q6_score_label(spark, sf_dir):
    return Q.labelled(rows(spark, sf_dir).where("value IS NOT NULL")).select("shard_key", "text")


@query("q6_score_label_ties", "SELECT event_id, printf('%.3f', (event_id % 40000) / 16.0) AS label FROM events")
def q6_score_label_ties(spark, sf_dir):
    """Numbers half way between two labels, which the binary value decides."""
    return table(spark, sf_dir, "events").select("event_id", score_label((F.col("event_id") % 40000) / 16.0).alias("label"))


@query(
    "q7_trend",
    f"""WITH {B1_SQL} SELECT ts_text, model_short, value FROM b1
        WHERE {SELECTED} AND model_short IN ('model-0', 'openrouter/model-1', 'model-5')""",
)
def q7_trend(spark, sf_dir):
    chosen = ["model-0", "openrouter/model-1", "model-5"]
    t = Q.trend(rows(spark, sf_dir), SUITE, TASK, METRIC, chosen)
    return t.select(stamp_text().alias("ts_text"), "model_short", "value")


@query("q7_trend_all_models", f"WITH {B1_SQL} SELECT ts_text, model_short, value FROM b1 WHERE {SELECTED}")
def q7_trend_all_models(spark, sf_dir):
    t = Q.trend(rows(spark, sf_dir), SUITE, TASK, METRIC, [])
    return t.select(stamp_text().alias("ts_text"), "model_short", "value")


@query(
    "q8_latest_by_model_task",
    f"""WITH {B1_SQL}, {_latest_sql("model, name", f"suite = '{SUITE}' AND metric = '{METRIC}' AND model IS NOT NULL")}
        SELECT model, name, value, ts_text FROM newest""",
)
def q8_latest_by_model_task(spark, sf_dir):
    r = Q.select_results(rows(spark, sf_dir), SUITE, metric=METRIC)
    newest = Q.latest_by_model_task(r.select("timestamp", "model", "name", "value", "shard_key"))
    return newest.select("model", "name", "value", stamp_text().alias("ts_text"))


_CELLS = ", ".join(
    f"max(CASE WHEN name = '{n}' THEN round_even(value * 10000, 0) / 10000 END) AS {n}" for n in PIVOT_NAMES
)


@query(
    "q9_summary_pivot",
    f"""WITH {B1_SQL}, {_latest_sql("model, name", f"suite = '{SUITE}' AND metric = '{METRIC}' AND model IS NOT NULL")}
        SELECT model_short AS "Model", {_CELLS} FROM newest GROUP BY model_short""",
)
def q9_summary_pivot(spark, sf_dir):
    return Q.summary_pivot(rows(spark, sf_dir), SUITE, METRIC, PIVOT_NAMES)


@query(
    "q10_no_data",
    f"""WITH {B1_SQL}, s AS (SELECT model, value FROM b1 WHERE suite = 'no such suite')
        SELECT model, value, CAST(NULL AS VARCHAR) AS message FROM s
        UNION ALL SELECT NULL, NULL, 'No data for this selection' WHERE NOT EXISTS (SELECT * FROM s)""",
)
def q10_no_data(spark, sf_dir):
    return Q.or_no_data(Q.select_results(rows(spark, sf_dir), "no such suite").select("model", "value"))


_FACETS = " UNION ".join(
    f"SELECT '{c}' AS facet, {c} AS value FROM b1 WHERE {c} IS NOT NULL" for c in ("suite", "name", "metric", "model")
)


@query("q11_facets", f"WITH {B1_SQL} {_FACETS}")
def q11_facets(spark, sf_dir):
    return Q.facets(rows(spark, sf_dir))


@query(
    "q12_facets_for_suite",
    f"""WITH {B1_SQL} SELECT 'name' AS facet, name AS value FROM b1 WHERE suite = '{SUITE}'
        UNION SELECT 'metric' AS facet, metric AS value FROM b1 WHERE suite = '{SUITE}'""",
)
def q12_facets_for_suite(spark, sf_dir):
    return Q.facets_for_suite(rows(spark, sf_dir), SUITE)


@query(
    "q13_default_selection",
    f"""WITH {B1_SQL} SELECT CASE WHEN bool_or(suite = 'reasoning') THEN 'reasoning' ELSE min(suite) END AS suite,
        min(name) AS task,
        CASE WHEN bool_or(metric = 'exact_match_flexible') THEN 'exact_match_flexible' ELSE min(metric) END AS metric FROM b1""",
)
def q13_default_selection(spark, sf_dir):
    return Q.default_selection(rows(spark, sf_dir))


@query(
    "q13_default_selection_by_suite",
    f"""WITH {B1_SQL} SELECT suite, min(name) AS task,
        CASE WHEN bool_or(metric = 'exact_match_flexible') THEN 'exact_match_flexible' ELSE min(metric) END AS metric
        FROM b1 GROUP BY suite""",
)
def q13_default_selection_by_suite(spark, sf_dir):
    return Q.default_selection_by_suite(rows(spark, sf_dir))


@query("q14_dataset_stats", f"WITH {B1_SQL} SELECT count(*) AS n_rows, count(DISTINCT model) AS n_models FROM b1")
def q14_dataset_stats(spark, sf_dir):
    return Q.dataset_stats(rows(spark, sf_dir))


@query(
    "q15_first_models",
    f"""WITH {B1_SQL} SELECT model, min(model_short) AS model_short FROM b1 WHERE model IS NOT NULL
        GROUP BY model ORDER BY model LIMIT 6""",
)
def q15_first_models(spark, sf_dir):
    return Q.first_models(rows(spark, sf_dir))


@query(
    "s3_empty_results",
    f"""WITH {B1_SQL} SELECT ts_text, suite, name, metric, model, value, model_short FROM b1 WHERE value IS NOT NULL""",
)
def s3_empty_results(spark, sf_dir):
    """The empty dataset takes part in any query like a full one: here it is united with all scored rows."""
    columns = ["timestamp", "suite", "name", "metric", "model", "value", "model_short"]
    both = empty_results(spark).unionByName(rows(spark, sf_dir).where("value IS NOT NULL").select(columns))
    return both.select(stamp_text().alias("ts_text"), *columns[1:])
