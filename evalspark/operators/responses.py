"""Model responses to predictions; prompts from problem tables."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evalspark.functions import responses as R

# The prompt texts of the two scoring tasks.
COMPLETION_PROMPT = "Write a solution to the following problem and make sure that it passes the tests:\n```python\n{prompt}\n```\n"
COMPLETION_TARGET = "{test}\ncheck({entry_point})"
TASK_PROMPT = "You are an expert Python programmer, and here is your task:\n{text}\nYour code should pass these tests:\n{test_list[0]}\n{test_list[1]}\n{test_list[2]}"
TASK_TARGET = "{test_list[0]}\n{test_list[1]}\n{test_list[2]}"
FEWSHOT_TARGET = "{code}\n```"
FEWSHOT_EXAMPLES = 3
# end of fixed values

RESPONSE_ALONE = "response without doc"
DOC_ALONE = "doc without response"
DOC_REPEATED = "doc listed more than once"
TOO_MANY = "too many responses"
TOO_FEW = "too few responses"
NO_KEY = "key is missing"


def pair_responses(responses: DataFrame, docs: DataFrame, on: str = "doc_id") -> DataFrame:
    """Responses with the problem they answer. Check :func:`unpaired` first: both sides must line up.

    An inner equi-join, so a problem with most of the responses is split by adaptive execution.
    """
    return responses.join(docs, on)


def _stated_once(docs: DataFrame, on: str) -> DataFrame:
    """``docs`` with ``_stated``, how often a key is listed; the join on the key uses the same shuffle."""
    return docs.withColumn("_stated", F.count(F.lit(1)).over(Window.partitionBy(on)))


def pair_all(responses: DataFrame, docs: DataFrame, on: str = "doc_id", unanswered: str = "error") -> DataFrame:
    """Like :func:`pair_responses` for inputs that must line up: one row for each response, or the job fails.

    It fails at the first key that one side lacks, that has no value, or that the problems list more than once: a
    response has one problem, and a join would double it in silence. A problem may have any number of responses, as
    many as were sampled; :func:`parity` tells how many. With ``unanswered='skip'`` problems without a response are left
    out.
    """
    left = responses.withColumn("_answered", F.lit(True))
    both = left.join(_stated_once(docs, on), on, "full" if unanswered == "error" else "left")

    def fail(why: str) -> Column:
        return F.raise_error(F.concat(F.lit(f"{why}: "), F.coalesce(F.col(on).cast("string"), F.lit("NULL")))).cast("boolean")

    lines_up = F.when(F.col("_stated").isNull(), fail("response without problem"))
    lines_up = lines_up.when(F.col("_stated") > 1, fail("problem listed more than once"))
    lines_up = lines_up.when(F.col("_answered").isNull(), fail("problem without response")).otherwise(True)
    return both.where(lines_up).drop("_answered", "_stated")


def pair_or_reject(responses: DataFrame, docs: DataFrame, on: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """``(paired, rejects)``: every response stands in one of them, once.

    ``paired`` has the responses whose problem is listed once, ``rejects`` the other responses with ``side``. What is
    wrong with the problems themselves :func:`parity` tells.
    """
    both = responses.join(_stated_once(docs, on), on, "left")
    # Of a problem that is listed several times every copy met the response; one of them is enough to tell.
    once = both.where(F.col("_stated") == 1).drop("_stated")
    listed = docs.groupBy(on).agg(F.count(F.lit(1)).alias("_stated"))
    bad = responses.join(listed, on, "left").where(F.col("_stated").isNull() | (F.col("_stated") > 1))
    side = F.when(F.col("_stated").isNull(), RESPONSE_ALONE).otherwise(DOC_REPEATED)
    return once, bad.withColumn("side", side).drop("_stated")


def parity(responses: DataFrame, docs: DataFrame, on: str = "doc_id", per_doc: int | None = None) -> DataFrame:
    """``(key, n_responses, n_docs, side)``: the keys at which the two sides do not line up, and how.

    A key must be listed by one problem, and by ``per_doc`` responses, or by any number but none where that is not given. One
    aggregation of the keys of both sides with partial sums, so a key with most of the responses is one row per task.
    """
    keys = responses.select(on, F.lit(1).alias("_r"), F.lit(0).alias("_d")).unionByName(docs.select(on, F.lit(0).alias("_r"), F.lit(1).alias("_d")))
    counts = keys.groupBy(on).agg(F.sum("_r").cast("bigint").alias("n_responses"), F.sum("_d").cast("bigint").alias("n_docs"))
    r, d = F.col("n_responses"), F.col("n_docs")
    side = F.when(F.col(on).isNull(), NO_KEY).when(d == 0, RESPONSE_ALONE).when(d > 1, DOC_REPEATED).when(r == 0, DOC_ALONE)
    if per_doc is not None:
        side = side.when(r > per_doc, TOO_MANY).when(r < per_doc, TOO_FEW)
    return counts.withColumn("side", side).where(F.col("side").isNotNull())


def unpaired(responses: DataFrame, docs: DataFrame, on: str = "doc_id") -> DataFrame:
    """Keys that only one side has: ``(key, side)``. Empty when the inputs line up."""
    return parity(responses, docs, on).where(F.col("side").isin(RESPONSE_ALONE, DOC_ALONE)).select(on, "side")


def clean_responses(df: DataFrame, response: str = "response") -> DataFrame:
    """Add ``cleaned`` and ``code``."""
    return df.withColumn("cleaned", R.strip_think(F.col(response))).withColumn("code", R.extract_code(F.col("cleaned")))


def completion_predictions(paired: DataFrame, response: str = "response", prompt: str = "prompt") -> DataFrame:
    """Add ``prediction``: the program to run for a prompt that is the start of the program."""
    return clean_responses(paired, response).withColumn(
        "prediction", R.completion(F.col("cleaned"), F.col("code"), F.col(prompt))
    )


def code_predictions(df: DataFrame, response: str = "response") -> DataFrame:
    """Add ``prediction``: the code of the response alone."""
    return clean_responses(df, response).withColumn("prediction", F.col("code"))


def render(template: str, **values: Column | str) -> Column:
    """Text of a template with ``{name}`` and ``{name[i]}`` (from 0) filled from columns of the row.

    The template is cut up when the query is built. A place whose value is NULL makes the text NULL.
    """
    parts: list[Column] = []
    for literal, field, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field:
            name, _, index = field.partition("[")
            value = values.get(name, name)
            column = F.col(value) if isinstance(value, str) else value
            parts.append(F.get(column, F.lit(int(index[:-1]))) if index else column)
    return F.concat(*parts)


def render_prompts(df: DataFrame, prompt_text: str, target_text: str, **values: Column | str) -> DataFrame:
    """Add ``rendered_prompt`` and ``rendered_target``. ``values`` says which column fills a name, if not its own."""
    rendered = {"rendered_prompt": render(prompt_text, **values), "rendered_target": render(target_text, **values)}
    return df.withColumns(rendered)


def first_n(df: DataFrame, n: int, order: list[str], per: list[str] | None = None) -> DataFrame:
    """The first ``n`` examples in key order, of the whole table or of every group.

    Both keep at most ``n`` rows per task (and group) before anything is shuffled.
    """
    if not per:
        return df.orderBy(*order).limit(n)
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(*per).orderBy(*order)))
    return ranked.where(F.col("_n") <= n).drop("_n")
