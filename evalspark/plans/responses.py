"""Queries over model responses and outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from evalspark.functions import responses as R
from evalspark.operators import responses as P
from evalspark.operators import scoring
from evalspark.plans.bindings import table
from evalspark.plans.registry import query

# How a response is dressed, by class: each stands for a way models answer.
_CODE = "def f(x):\\n    return x"
WRAPPED = """CASE conv_id % 8
  WHEN 0 THEN concat('<think>', text, '</think>\\n\\n', text)
  WHEN 1 THEN concat('Thinking Process: ', text, 'Here is the code:\\n```python\\ndef f():\\n    return 1\\n```\\nbye')
  WHEN 2 THEN concat(text, '\\n```python\\ndef f(x):\\n    return x\\n```\\n')
  WHEN 3 THEN concat('```python\\na = 1\\n```\\n', text, '\\n```python\\nb = 2\\n```')
  WHEN 4 THEN concat('```js\\nreturn 1;\\n```\\n', text)
  WHEN 5 THEN text
  WHEN 6 THEN concat('<think>', text)
  ELSE concat('```python\\n', prompt, '\\n    return 1\\n```') END"""

# chr(10) is the line break.
_N = "chr(10)"
_STRIPPED = "regexp_replace(text, '^\\s+', '')"
B6_SQL = f"""
resp AS (SELECT conv_id * 1000 + turn AS doc_id, conv_id, text FROM conversations WHERE role = 'assistant'),
prob AS (SELECT conv_id * 1000 + turn + 1 AS doc_id, text || {_N} || '  ' AS prompt FROM conversations WHERE role = 'user'),
b6 AS (SELECT resp.*, prompt FROM resp JOIN prob USING (doc_id)),
expect AS (
  SELECT doc_id, prompt,
    CASE conv_id % 8
      WHEN 0 THEN {_STRIPPED}
      WHEN 1 THEN 'Here is the code:' || {_N} || '```python' || {_N} || 'def f():' || {_N} || '    return 1' || {_N} || '```' || {_N} || 'bye'
      WHEN 2 THEN {_STRIPPED} || {_N} || '```python' || {_N} || 'def f(x):' || {_N} || '    return x' || {_N} || '```' || {_N}
      WHEN 3 THEN '```python' || {_N} || 'a = 1' || {_N} || '```' || {_N} || text || {_N} || '```python' || {_N} || 'b = 2' || {_N} || '```'
      WHEN 4 THEN '```js' || {_N} || 'return 1;' || {_N} || '```' || {_N} || text
      WHEN 5 THEN {_STRIPPED}
      WHEN 6 THEN '<think>' || text
      ELSE '```python' || {_N} || prompt || {_N} || '    return 1' || {_N} || '```' END AS cleaned,
    CASE conv_id % 8
      WHEN 1 THEN 'def f():' || {_N} || '    return 1'
      WHEN 2 THEN 'def f(x):' || {_N} || '    return x'
      WHEN 3 THEN 'b = 2'
      WHEN 4 THEN 'return 1;'
      WHEN 7 THEN prompt || {_N} || '    return 1'
      ELSE '' END AS code,
    CASE conv_id % 8
      WHEN 0 THEN prompt || {_STRIPPED}
      WHEN 1 THEN prompt || 'def f():' || {_N} || '    return 1'
      WHEN 2 THEN prompt || 'def f(x):' || {_N} || '    return x'
      WHEN 3 THEN prompt
      WHEN 4 THEN prompt || 'return 1;'
      WHEN 5 THEN prompt || {_STRIPPED}
      WHEN 6 THEN prompt || '<think>' || text
      ELSE prompt || {_N} || '    return 1' END AS completion
  FROM b6
)"""


def problems(spark, sf_dir):
    """``doc_id, prompt``: user turns, each the problem of the turn after it."""
    turns = table(spark, sf_dir, "conversations").where("role = 'user'")
    return turns.selectExpr("conv_id * 1000 + turn + 1 AS doc_id", "concat(text, '\\n  ') AS prompt")


def answers(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    return turns.selectExpr("conv_id * 1000 + turn AS doc_id", "conv_id", "text")


def responses(spark, sf_dir):
    """``doc_id, prompt, response`` of every response; each must have its prompt, which one class repeats."""
    paired = P.pair_all(answers(spark, sf_dir), problems(spark, sf_dir), unanswered="skip")
    return paired.select("doc_id", "prompt", F.expr(WRAPPED).alias("response"))


@query("t1_strip_think", f"WITH {B6_SQL} SELECT doc_id, cleaned FROM expect")
def t1_strip_think(spark, sf_dir):
    return responses(spark, sf_dir).select("doc_id", R.strip_think(F.col("response")).alias("cleaned"))


@query("t2_extract_code", f"WITH {B6_SQL} SELECT doc_id, code FROM expect")
def t2_extract_code(spark, sf_dir):
    return P.clean_responses(responses(spark, sf_dir)).select("doc_id", "code")


@query("t3_completion_predictions", f"WITH {B6_SQL} SELECT doc_id, completion AS prediction FROM expect")
def t3_completion_predictions(spark, sf_dir):
    return P.completion_predictions(responses(spark, sf_dir)).select("doc_id", "prediction")


@query("t4_code_predictions", f"WITH {B6_SQL} SELECT doc_id, code AS prediction FROM expect")
def t4_code_predictions(spark, sf_dir):
    return P.code_predictions(responses(spark, sf_dir)).select("doc_id", "prediction")


@query("t5_pair_responses", f"WITH {B6_SQL} SELECT doc_id, prompt, text FROM b6")
def t5_pair_responses(spark, sf_dir):
    return P.pair_responses(answers(spark, sf_dir), problems(spark, sf_dir)).select("doc_id", "prompt", "text")


@query(
    "t5_unpaired",
    f"""WITH {B6_SQL} SELECT doc_id, 'response without doc' AS side FROM resp WHERE doc_id NOT IN (SELECT doc_id FROM prob)
        UNION ALL SELECT doc_id, 'doc without response' AS side FROM prob WHERE doc_id NOT IN (SELECT doc_id FROM resp)""",
)
def t5_unpaired(spark, sf_dir):
    return P.unpaired(answers(spark, sf_dir), problems(spark, sf_dir))


# A copy of the problem list that states some problems again, and answers to problems of which some are not there.
_AGAIN = "prob2 AS (SELECT doc_id FROM prob UNION ALL SELECT doc_id FROM prob WHERE doc_id % 10 = 3)"


def _repeated_problems(spark, sf_dir):
    docs = problems(spark, sf_dir)
    return docs.unionByName(docs.where("doc_id % 10 = 3"))


@query(
    "t5_parity",
    f"""WITH {B6_SQL}, {_AGAIN},
        r AS (SELECT doc_id, count(*) AS n_responses FROM resp GROUP BY doc_id), d AS (SELECT doc_id, count(*) AS n_docs FROM prob2 GROUP BY doc_id),
        b AS (SELECT doc_id, coalesce(n_responses, 0) AS n_responses, coalesce(n_docs, 0) AS n_docs FROM r FULL JOIN d USING (doc_id))
        SELECT *, CASE WHEN n_docs = 0 THEN 'response without doc' WHEN n_docs > 1 THEN 'doc listed more than once'
          WHEN n_responses = 0 THEN 'doc without response' ELSE 'too many responses' END AS side
        FROM b WHERE n_docs <> 1 OR n_responses <> 1""",
)
def t5_parity(spark, sf_dir):
    """What does not line up one to one, where problems are listed again."""
    return P.parity(answers(spark, sf_dir), _repeated_problems(spark, sf_dir), per_doc=1)


@query(
    "t5_pair_or_reject",
    f"""WITH {B6_SQL}, {_AGAIN}, d AS (SELECT doc_id, count(*) AS n FROM prob2 GROUP BY doc_id)
        SELECT resp.doc_id, CASE WHEN n IS NULL THEN 'response without doc' WHEN n > 1 THEN 'doc listed more than once' ELSE 'paired' END AS side
        FROM resp LEFT JOIN d USING (doc_id)""",
)
def t5_pair_or_reject(spark, sf_dir):
    """One row for each response, whatever the problem list is like."""
    paired, rejects = P.pair_or_reject(answers(spark, sf_dir), _repeated_problems(spark, sf_dir))
    return paired.select("doc_id", F.lit("paired").alias("side")).unionByName(rejects.select("doc_id", "side"))


_OUTCOMES_SQL = "o AS (SELECT lang, source, quality FROM labels JOIN documents USING (doc_id))"


def outcomes(spark, sf_dir):
    """One row per sample: ``lang`` is the task, ``source`` the problem."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return labels.join(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), "doc_id")


def _pass_sql(k: int) -> str:
    wrong = " * ".join(f"((n - c - {i}) / CAST(n - {i} AS DOUBLE))" for i in range(k))
    each = "c / CAST(n AS DOUBLE)" if k == 1 else f"CASE WHEN n - c < {k} THEN 1.0 ELSE 1.0 - {wrong} END"
    return f"round(CASE WHEN min(n) >= {k} THEN avg(CASE WHEN n >= {k} THEN {each} END) END, 10) AS pass_at_{k}"


@query(
    "t6_pass_at_k",
    f"""WITH {_OUTCOMES_SQL}, p AS (SELECT lang, source, count(*) AS n, sum(quality) AS c FROM o GROUP BY lang, source)
        SELECT lang, count(*) AS n_problems, {_pass_sql(1)}, {_pass_sql(2)}, {_pass_sql(5)} FROM p GROUP BY lang""",
)
def t6_pass_at_k(spark, sf_dir):
    scores = scoring.pass_at_k(outcomes(spark, sf_dir), [1, 2, 5], ["lang"], "source", "quality")
    return scores.select("lang", "n_problems", *[F.round(f"pass_at_{k}", 10).alias(f"pass_at_{k}") for k in (1, 2, 5)])


@query(
    "t6_scores_to_results",
    f"""WITH {_OUTCOMES_SQL}, p AS (SELECT lang, source, count(*) AS n, sum(quality) AS c FROM o GROUP BY lang, source),
        s AS (SELECT lang, {_pass_sql(1)} FROM p GROUP BY lang)
        SELECT lang AS name, 'pass@1,none' AS metric_key, pass_at_1 AS value FROM s""",
)
def t6_scores_to_results(spark, sf_dir):
    scores = scoring.pass_at_k(outcomes(spark, sf_dir), [1], ["lang"], "source", "quality")
    rows = scoring.scores_to_results(scores, "lang", [1])
    return rows.withColumn("value", F.round("value", 10))


@query(
    "t7_render_prompts",
    """SELECT doc_id,
         'You are an expert Python programmer, and here is your task:' || chr(10) || text || chr(10)
           || 'Your code should pass these tests:' || chr(10) || lang || chr(10) || source || chr(10) || CAST(n_chars AS VARCHAR) AS rendered_prompt,
         lang || chr(10) || source || chr(10) || CAST(n_chars AS VARCHAR) AS rendered_target
       FROM documents""",
)
def t7_render_prompts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    tests = docs.withColumn("test_list", F.array("lang", "source", F.col("n_chars").cast("string")))
    return P.render_prompts(tests, P.TASK_PROMPT, P.TASK_TARGET).select("doc_id", "rendered_prompt", "rendered_target")


@query(
    "t7_render_fewshot",
    """SELECT doc_id, lang AS rendered_prompt, text || chr(10) || '```' AS rendered_target FROM (
         SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents) WHERE n <= 3""",
)
def t7_render_fewshot(spark, sf_dir):
    """The worked examples of each task: their target is the code and the fence that ends it."""
    docs = P.first_n(table(spark, sf_dir, "documents"), P.FEWSHOT_EXAMPLES, ["doc_id"], ["source"])
    done = P.render_prompts(docs, "{lang}", P.FEWSHOT_TARGET, code="text")
    return done.select("doc_id", "rendered_prompt", "rendered_target")


@query(
    "t7_render_completion_prompts",
    """SELECT doc_id,
         'Write a solution to the following problem and make sure that it passes the tests:' || chr(10) || '```python' || chr(10)
           || text || chr(10) || '```' || chr(10) AS rendered_prompt,
         source || chr(10) || 'check(' || lang || ')' AS rendered_target
       FROM documents""",
)
def t7_render_completion_prompts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    done = P.render_prompts(docs, P.COMPLETION_PROMPT, P.COMPLETION_TARGET, prompt="text", test="source", entry_point="lang")
    return done.select("doc_id", "rendered_prompt", "rendered_target")


@query("t8_first_n", "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 10")
def t8_first_n(spark, sf_dir):
    return P.first_n(table(spark, sf_dir, "documents").select("doc_id", "text"), 10, ["doc_id"])


@query(
    "t8_first_n_per_task",
    """SELECT source, doc_id, lang FROM (
         SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents) WHERE n <= 3""",
)
def t8_first_n_per_task(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", "lang")
    return P.first_n(docs, P.FEWSHOT_EXAMPLES, ["doc_id"], ["source"])
