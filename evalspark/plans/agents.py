"""Queries over agent transcripts."""

from __future__ import annotations

from pyspark.sql import functions as F

from evalspark.operators import agents as A
from evalspark.operators.parts import numbered_within
from evalspark.plans.bindings import table
from evalspark.plans.registry import query

TOOL = """CASE conv_id % 4 WHEN 3 THEN 'web_search' ELSE 'file_read' END"""
ARGS = """CASE conv_id % 4
  WHEN 1 THEN '{"path": '
  WHEN 2 THEN concat('{"path": "/etc/p', turn, '"}')
  ELSE CASE WHEN turn > 2 THEN '{"path": "/tmp/gone.txt"}' ELSE '{"path": "/tmp/eval-test.txt"}' END END"""
HAS_CALL = "role = 'assistant' AND (turn % 3 = 1 OR conv_id % 5 = 0)"
STEP = "CAST((turn + 1) / 2 AS INT)"

B8_SQL = f"""
tr AS (
  SELECT conv_id AS run_id, turn, CAST((turn + 1) // 2 AS INTEGER) AS step, role, conv_id,
         CASE WHEN turn = 5 THEN '' ELSE text END AS content, {HAS_CALL} AS has_call, {TOOL} AS tool, {ARGS} AS args,
         CASE conv_id % 3 WHEN 0 THEN CAST(length(text) AS BIGINT) WHEN 1 THEN 0 END AS total_tokens,
         CASE WHEN turn <> 4 THEN CAST(length(text) + 1 AS BIGINT) END AS completion_tokens,
         CAST(turn * turn * 1250 AS BIGINT) AS at_ms
  FROM conversations
)"""


def transcript(spark, sf_dir):
    """One message per conversation turn; some model turns call a tool."""
    c = table(spark, sf_dir, "conversations")
    call = f"named_struct('tool', {TOOL}, 'args', {ARGS})"
    calls = f"IF({HAS_CALL}, IF(turn = 3, array({call}, {call}), array({call})), array())"
    return c.selectExpr(
        "conv_id AS run_id",
        "CAST(floor((turn + 1) / 2) AS INT) AS step",
        "timestamp_millis(1704067200000 + turn * turn * 1250) AS ts",
        "role",
        "IF(turn = 5, '', text) AS content",
        f"{calls} AS tool_calls",
        "CASE conv_id % 3 WHEN 0 THEN CAST(length(text) AS BIGINT) WHEN 1 THEN 0L END AS total_tokens",
        "IF(turn <> 4, CAST(length(text) + 1 AS BIGINT), NULL) AS completion_tokens",
    )


_ANSWER = "CASE WHEN coalesce({c}, '') = '' THEN '(empty)' ELSE left({c}, 200) END"


@query(
    "a1_summarize_runs",
    f"""WITH {B8_SQL},
        f AS (SELECT run_id, min(CASE WHEN role = 'assistant' AND NOT has_call THEN step END) AS final, min(at_ms) AS start, max(at_ms) AS last
              FROM tr WHERE step <= 5 GROUP BY run_id),
        s AS (SELECT tr.run_id, final, start, last,
                sum(CASE WHEN role = 'assistant' AND step <= coalesce(final, 5)
                    THEN CASE WHEN coalesce(total_tokens, 0) <> 0 THEN total_tokens ELSE coalesce(completion_tokens, 0) END ELSE 0 END) AS tokens,
                max(CASE WHEN role = 'assistant' AND step = final THEN content END) AS content,
                max(CASE WHEN role = 'assistant' AND step = final THEN at_ms END) AS at_final
              FROM tr JOIN f USING (run_id) GROUP BY tr.run_id, final, start, last)
        SELECT run_id, CASE WHEN final IS NULL THEN '(max steps reached)' ELSE {_ANSWER.format(c="content")} END AS answer,
          CAST(coalesce(final, 5) AS INTEGER) AS steps, CAST(tokens AS BIGINT) AS tokens,
          round((coalesce(at_final, last) - start) / CAST(1000 AS DOUBLE), 2) AS latency FROM s""",
)
def a1_summarize_runs(spark, sf_dir):
    return A.summarize_runs(transcript(spark, sf_dir))


# A run for every user, a turn for every event, in order of their numbers: runs of any length, one with a third of all.
_LONG_RUN = "CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END"
_LONG_SQL = f"""
lr AS (
  SELECT {_LONG_RUN} AS run_id, CAST(row_number() OVER (PARTITION BY {_LONG_RUN} ORDER BY event_id) AS INTEGER) AS step,
         event_type IN ('purchase', 'signup') AND event_id % 7 = 0 AS done, event_id, epoch_us(ts) AS us, event_id % 100 AS tokens
  FROM events
)"""


def long_transcript(spark, sf_dir):
    """Turns numbered within their run, with no bound on their number."""
    events = table(spark, sf_dir, "events").withColumn("run_id", F.expr(_LONG_RUN).cast("bigint"))
    turns = numbered_within(events.select("run_id", "event_id", "event_type", "ts"), ["run_id"], ["event_id"], "number")
    done = F.col("event_type").isin("purchase", "signup") & (F.col("event_id") % 7 == 0)
    call = F.array(F.struct(F.lit("file_read").alias("tool"), F.lit("{}").alias("args")))
    return turns.select(
        "run_id",
        (F.col("number") + 1).cast("int").alias("step"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit("assistant").alias("role"),
        F.concat(F.lit("said "), F.col("event_id").cast("string")).alias("content"),
        F.when(done, F.array().cast("array<struct<tool: string, args: string>>")).otherwise(call).alias("tool_calls"),
        (F.col("event_id") % 100).alias("total_tokens"),
        F.lit(0).cast("bigint").alias("completion_tokens"),
    )


@query(
    "a1_long_runs",
    f"""WITH {_LONG_SQL}, f AS (SELECT run_id, min(step) FILTER (done) AS final, max(step) AS turns, min(us) AS start, max(us) AS last FROM lr GROUP BY run_id)
        SELECT run_id, coalesce(max(CASE WHEN step = final THEN 'said ' || event_id END), '(empty)') AS answer,
          coalesce(final, turns) AS steps, CAST(sum(CASE WHEN step <= coalesce(final, turns) THEN tokens ELSE 0 END) AS BIGINT) AS tokens,
          round((coalesce(max(CASE WHEN step = final THEN us END), last) - start) / CAST(1000000 AS DOUBLE), 2) AS latency
        FROM lr JOIN f USING (run_id) GROUP BY run_id, final, turns, start, last""",
)
def a1_long_runs(spark, sf_dir):
    """Runs without a limit on their steps; most go on after their final turn."""
    return A.summarize_runs(long_transcript(spark, sf_dir), max_steps=None)


_CALLS_SQL = f"""{B8_SQL},
calls AS (
  SELECT run_id, step, turn, conv_id, unnest(CASE WHEN turn = 3 THEN [0, 1] ELSE [0] END) AS position, tool, args
  FROM tr WHERE has_call
)"""


@query("a2_tool_calls", f"WITH {_CALLS_SQL} SELECT run_id, step, CAST(position AS INTEGER) AS position, tool, args FROM calls")
def a2_tool_calls(spark, sf_dir):
    return A.tool_calls(transcript(spark, sf_dir))


@query(
    "a2_tool_call_lists",
    f"""WITH {_CALLS_SQL}, ends AS (SELECT run_id, min(step) FILTER (role = 'assistant' AND NOT has_call) AS final FROM tr GROUP BY run_id)
        SELECT ends.run_id, coalesce(string_agg(tool || ' ' || args, ';' ORDER BY step, position), '') AS tool_calls
        FROM ends LEFT JOIN calls ON calls.run_id = ends.run_id AND (final IS NULL OR step < final) GROUP BY ends.run_id""",
)
def a2_tool_call_lists(spark, sf_dir):
    lists = A.tool_call_lists(transcript(spark, sf_dir))
    shown = F.array_join(F.transform("tool_calls", lambda c: F.concat(c["tool"], F.lit(" "), c["args"])), ";")
    return lists.select("run_id", shown.alias("tool_calls"))


@query(
    "a3_tool_call_status",
    f"""WITH {_CALLS_SQL} SELECT run_id, step, CAST(position AS INTEGER) AS position,
          CASE conv_id % 4 WHEN 1 THEN 'Error: malformed tool arguments' WHEN 3 THEN 'Error: Unknown tool: web_search'
            WHEN 2 THEN 'Error: path not allowed: /etc/p' || CAST(turn AS VARCHAR)
            ELSE CASE WHEN turn > 2 THEN 'Error: File not found: /tmp/gone.txt' ELSE 'ok' END END AS status
        FROM calls""",
)
def a3_tool_call_status(spark, sf_dir):
    files = spark.createDataFrame([("/tmp/eval-test.txt",)], "path STRING")
    allowed = ["/tmp/eval-test.txt", "/tmp/gone.txt"]
    status = A.tool_call_status(A.tool_calls(transcript(spark, sf_dir)), files, allowed=allowed)
    return status.select("run_id", "step", "position", "status")


@query(
    "a4_steps_from_calls",
    f"""WITH {B8_SQL},
        n AS (SELECT run_id, sum(CASE WHEN has_call THEN CASE WHEN turn = 3 THEN 2 ELSE 1 END ELSE 0 END) AS calls,
                min(at_ms) AS start, max(at_ms) AS last FROM tr GROUP BY run_id),
        said AS (SELECT run_id, content, row_number() OVER (PARTITION BY run_id ORDER BY turn DESC) AS r
                 FROM tr WHERE role = 'assistant' AND content <> '')
        SELECT n.run_id, {_ANSWER.format(c="content")} AS answer, CAST(calls + 1 AS BIGINT) AS steps,
          round((last - start) / CAST(1000 AS DOUBLE), 2) AS latency
        FROM n LEFT JOIN (SELECT * FROM said WHERE r = 1) USING (run_id)""",
)
def a4_steps_from_calls(spark, sf_dir):
    return A.steps_from_calls(transcript(spark, sf_dir))


_RUN_ANSWER = "CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE repeat(concat(o_orderpriority, ' '), 30) END"
_RUN_ERROR = "CASE WHEN o_orderstatus = 'F' THEN concat('failed at ', CAST(o_totalprice AS VARCHAR(20))) END"


def agent_runs(spark, sf_dir):
    """One run per order: its answer or error, and how long it took."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS run_id",
        "concat('model-', o_custkey % 40) AS model",
        "o_orderpriority AS framework",
        f"{_RUN_ANSWER} AS answer",
        "IF(o_orderstatus = 'F', concat('failed at ', o_totalprice), NULL) AS error",
        "CAST(o_orderdate AS TIMESTAMP) AS started",
        "timestamp_micros(unix_micros(CAST(o_orderdate AS TIMESTAMP)) + (o_orderkey % 700) * 250000) AS ended",
        "o_orderstatus = 'O' AS passed",
        "IF(o_orderkey % 3 = 0, NULL, o_custkey) AS tokens",
    )


@query(
    "a5_error_answers",
    f"""SELECT o_orderkey AS run_id, CASE WHEN coalesce(a, '') = '' THEN '(empty)' ELSE left(a, 200) END AS answer,
          CAST((o_orderkey % 700) * 0.25 AS DOUBLE) AS latency
        FROM (SELECT *, coalesce('Error: ' || {_RUN_ERROR}, {_RUN_ANSWER}) AS a FROM orders)""",
)
def a5_error_answers(spark, sf_dir):
    return A.error_answers(agent_runs(spark, sf_dir))


@query(
    "a6_runs_to_results",
    """SELECT run_id, suite, name, x.metric AS metric, CAST(x.v AS DOUBLE) AS value, x.unit AS unit FROM (
         SELECT o_orderkey AS run_id, 'framework-eval' AS suite, o_orderpriority AS name, unnest([
           {'metric': 'score', 'v': CASE WHEN o_orderstatus = 'O' THEN 1.0 ELSE 0.0 END, 'unit': 'bool'},
           {'metric': 'latency', 'v': CAST((o_orderkey % 700) * 0.25 AS DOUBLE), 'unit': 'sec'},
           {'metric': 'tokens', 'v': CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END, 'unit': 'tokens'}]) AS x
         FROM orders) WHERE x.v IS NOT NULL""",
)
def a6_runs_to_results(spark, sf_dir):
    runs = agent_runs(spark, sf_dir).withColumn("latency", A.seconds_between(F.col("started"), F.col("ended")))
    results = A.runs_to_results(runs)
    rows = results.select("run_id", "suite", F.explode("results").alias("r"))
    return rows.select("run_id", "suite", "r.name", "r.metric", "r.value", "r.unit")


@query(
    "a6_runs_to_envelopes",
    """SELECT run_id, 'framework-eval' AS suite, 'model-' || CAST(c % 40 AS VARCHAR) AS model, 'unknown' AS git_sha, 'local' AS trigger,
          strftime(d + to_microseconds((run_id % 700) * 250000), '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp, x.metric AS metric,
          CAST(x.v AS DOUBLE) AS value
       FROM (SELECT o_orderkey AS run_id, o_custkey AS c, CAST(o_orderdate AS TIMESTAMP) AS d, unnest([
           {'metric': 'score', 'v': CASE WHEN o_orderstatus = 'O' THEN 1.0 ELSE 0.0 END},
           {'metric': 'latency', 'v': CAST((o_orderkey % 700) * 0.25 AS DOUBLE)},
           {'metric': 'input_tokens', 'v': CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END},
           {'metric': 'output_tokens', 'v': CAST(o_orderkey % 997 AS DOUBLE)}]) AS x FROM orders) WHERE x.v IS NOT NULL""",
)
def a6_runs_to_envelopes(spark, sf_dir):
    """Runs as envelopes that keep the model, with input and output tokens apart."""
    runs = agent_runs(spark, sf_dir).withColumn("latency", A.seconds_between(F.col("started"), F.col("ended")))
    runs = runs.withColumnRenamed("tokens", "input_tokens").withColumn("output_tokens", F.col("run_id") % 997)
    rows = A.runs_to_envelopes(runs).withColumn("r", F.explode("results"))
    return rows.select("run_id", "suite", "model", "git_sha", "trigger", "timestamp", "r.metric", "r.value")


_MOST_RUNS = 7


@query(
    "a6_envelopes_by_framework",
    f"""WITH runs AS (
          SELECT o_orderkey AS run_id, 'model-' || CAST(o_custkey % 40 AS VARCHAR) AS model, o_orderpriority AS framework,
            CAST(o_orderdate AS TIMESTAMP) + to_microseconds((o_orderkey % 700) * 250000) AS ended, o_orderstatus, o_orderkey, o_custkey
          FROM orders),
        n AS (SELECT *, (row_number() OVER (PARTITION BY model, framework ORDER BY ended, run_id) - 1) // {_MOST_RUNS} AS part FROM runs),
        e AS (SELECT *, strftime(max(ended) OVER (PARTITION BY model, framework, part), '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp, unnest([
               {{'i': 0, 'metric': 'score', 'v': CASE WHEN o_orderstatus = 'O' THEN 1.0 ELSE 0.0 END}},
               {{'i': 1, 'metric': 'latency', 'v': CAST((o_orderkey % 700) * 0.25 AS DOUBLE)}},
               {{'i': 2, 'metric': 'tokens', 'v': CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END}}]) AS x FROM n)
        SELECT model, framework, CAST(part AS INTEGER) AS part, timestamp, run_id::VARCHAR AS run_id, x.metric AS metric, CAST(x.v AS DOUBLE) AS value,
          CAST(row_number() OVER (PARTITION BY model, framework, part ORDER BY ended, run_id, x.i) - 1 AS INTEGER) AS place
        FROM e WHERE x.v IS NOT NULL""",
)
def a6_envelopes_by_framework(spark, sf_dir):
    """One envelope per model and framework, of as many parts as its runs need, shown result by result in order."""
    runs = agent_runs(spark, sf_dir).withColumn("latency", A.seconds_between(F.col("started"), F.col("ended")))
    envelopes = A.framework_envelopes(runs, _MOST_RUNS)
    rows = envelopes.select("model", "framework", "part", "timestamp", F.posexplode("results").alias("place", "r"))
    return rows.select("model", "framework", "part", "timestamp", F.col("r.tags")["run_id"].alias("run_id"), "r.metric", "r.value", "place")
