"""Summaries of agent runs from transcripts.

A transcript row is one message: ``run_id, step, ts, role, content, tool_calls, total_tokens, completion_tokens``.
``step`` numbers the model's turns from 1, ``tool_calls`` is an array of ``(tool, args)`` structs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.functions.let import computed_once, let
from evalspark.operators.convert import assemble_envelopes, fill_run_context
from evalspark.operators.parts import in_parts
from evalspark.schemas import ENVELOPE_COLUMNS
from evalspark.session import written

# What the harness reports.
MAX_STEPS = 5
ANSWER_LENGTH = 200
EMPTY_ANSWER = "(empty)"
STEPS_EXHAUSTED = "(max steps reached)"
KNOWN_TOOLS = ["file_read"]
ALLOWED_PATHS = ["/tmp/eval-test.txt"]
MALFORMED_ARGUMENTS = "Error: malformed tool arguments"
UNKNOWN_TOOL = "Error: Unknown tool: "
PATH_NOT_ALLOWED = "Error: path not allowed: "
FILE_NOT_FOUND = "Error: File not found: "
# end of fixed values
NO_OBJECT = "Error: tool arguments are not an object"
# Runs that have more than this share of all rows are few; see _up_to_final.
HOT_RUNS = 1_000
# Runs whose results one document holds.
MOST_RUNS = 2_000


def answer_text(answer: Column) -> Column:
    return F.coalesce(F.nullif(F.left(answer, F.lit(ANSWER_LENGTH)), F.lit("")), F.lit(EMPTY_ANSWER))


def message_tokens(total: Column, completion: Column) -> Column:
    """Total tokens, or the completion's where the total is missing or 0, or none."""
    return F.coalesce(F.nullif(total, F.lit(0)), completion, F.lit(0)).cast("bigint")


def seconds_between(start: Column, end: Column) -> Column:
    return F.round((F.unix_micros(end) - F.unix_micros(start)) / 1e6, 2)


def summarize_runs(transcript: DataFrame, max_steps: int | None = MAX_STEPS) -> DataFrame:
    """``answer, steps, tokens, latency`` of every run: its first model turn without tool calls ends it.

    With a bound rows past ``max_steps`` do not count, whoever wrote them, and a run that never ended has reached it. With
    ``None`` runs may have any number of steps; one that never ended has no answer, and the steps it made.

    One aggregation with partial sums, whatever the number of steps: it finds each run's final turn, and the sums of all
    its rows, which are those up to that turn unless the model was asked again after it. Only the rows of such runs
    are looked at a second time. A run with many rows sends one row per task both times.
    """
    is_turn = F.col("role") == "assistant"
    step = F.col("step")
    final = is_turn & (F.coalesce(F.size("tool_calls"), F.lit(0)) <= 0)
    tokens = message_tokens(F.col("total_tokens"), F.col("completion_tokens"))
    rows = transcript if max_steps is None else transcript.where(F.coalesce(step, F.lit(0)) <= max_steps)
    # Texts are cut before the aggregation sorts and shuffles its rows.
    used = computed_once(
        rows.select(
            "run_id",
            "ts",
            F.when(is_turn, step).alias("_step"),
            F.when(final, step).alias("_end"),
            F.when(final, F.left("content", F.lit(ANSWER_LENGTH))).alias("_said"),
            tokens.alias("_tokens"),
        )
    )
    last_turn = F.max(F.when(F.col("_step").isNotNull(), F.struct("_step", "ts")))
    runs = written(
        used.groupBy("run_id").agg(
            F.min("_end").alias("_final"),
            F.min_by("_said", "_end").alias("_answer"),
            F.min("ts").alias("_start"),
            F.max("ts").alias("_last"),
            last_turn.alias("_turn"),
            F.coalesce(F.sum(F.when(F.col("_step").isNotNull(), F.col("_tokens"))), F.lit(0)).alias("_spent"),
            F.count(F.lit(1)).alias("_n"),
        ),
        "runs",
    )
    went_on = runs.where(F.col("_turn._step") > F.col("_final"))
    if went_on.limit(1).count():
        # Written, so that the join knows how few they are.
        upto = written(_up_to_final(used, went_on.select("run_id", "_final", "_n"), runs), "went-on")
        runs = runs.join(upto, "run_id", "left")
    else:
        none = {"_spent_then": "bigint", "_at_then": "timestamp"}
        runs = runs.withColumns({c: F.lit(None).cast(t) for c, t in none.items()})
    ended = F.col("_final").isNotNull()
    unended = F.lit(STEPS_EXHAUSTED if max_steps is not None else EMPTY_ANSWER)
    at_final = F.when(ended, F.coalesce("_at_then", "_turn.ts")).otherwise(F.col("_last"))
    steps = F.coalesce("_final", F.lit(max_steps) if max_steps is not None else F.coalesce("_turn._step", F.lit(0)))
    return runs.select(
        "run_id",
        F.when(ended, answer_text(F.col("_answer"))).otherwise(unended).alias("answer"),
        steps.cast("int").alias("steps"),
        F.coalesce("_spent_then", "_spent").cast("bigint").alias("tokens"),
        seconds_between(F.col("_start"), at_final).alias("latency"),
    )


def _up_to_final(used: DataFrame, went_on: DataFrame, runs: DataFrame) -> DataFrame:
    """``run_id, _spent_then, _at_then``: tokens up to the final turn and the time of it, for runs that went on after it.

    Runs with more than one in ``HOT_RUNS`` of all rows, of which there can be no more than that, are told to all tasks;
    the rows of the others meet them in a join, so that no task gets the rows of a run that has very many.
    """
    total = runs.agg(F.sum("_n")).first()[0]
    is_hot = F.col("_n") * HOT_RUNS > total
    hot = F.broadcast(went_on.where(is_hot).select("run_id", "_final"))
    hot_runs = F.broadcast(runs.where(is_hot).select("run_id"))
    turns = used.where("_step IS NOT NULL").select("run_id", "ts", "_step", "_tokens")
    rest = turns.join(hot_runs, "run_id", "left_anti").join(went_on.where(~is_hot).select("run_id", "_final"), "run_id")
    both = turns.join(hot, "run_id").unionByName(rest).where(F.col("_step") <= F.col("_final"))
    at_final = F.max(F.when(F.col("_step") == F.col("_final"), F.col("ts")))
    return both.groupBy("run_id").agg(F.sum("_tokens").alias("_spent_then"), at_final.alias("_at_then"))


def tool_calls(transcript: DataFrame, max_steps: int | None = None) -> DataFrame:
    """One row per tool call with its place: ``run_id, step, position, tool, args``. A narrow step.

    A turn that a streaming framework reports again repeats its calls; :func:`distinct_calls` keeps one of each.
    """
    turns = transcript if max_steps is None else transcript.where(F.col("step") <= max_steps)
    rows = turns.where(F.col("role") == "assistant").select(
        "run_id", "step", F.posexplode_outer("tool_calls").alias("position", "call")
    )
    return rows.where(F.col("call").isNotNull()).select("run_id", "step", "position", "call.tool", "call.args")


def distinct_calls(calls: DataFrame) -> DataFrame:
    return calls.dropDuplicates(["run_id", "step", "position"])


def tool_call_lists(transcript: DataFrame, max_steps: int | None = None) -> DataFrame:
    """Calls of each run as one ordered array, empty for a run without calls.

    A run ends with its first model turn that calls nothing; what a transcript has after it does not count. There is no
    bound on the steps unless one is given. Turns are grouped, not calls, and a turn that was reported again counts
    once: its longest report, since streaming frameworks repeat a turn as it grows.
    """
    is_turn = F.col("role") == "assistant"
    calls = F.coalesce("tool_calls", F.array().cast("array<struct<tool: string, args: string>>"))
    counts = is_turn if max_steps is None else is_turn & (F.col("step") <= max_steps)
    turn = F.struct(F.col("step").alias("step"), F.size(calls).alias("n"), calls.alias("calls"))
    turns = F.array_sort(F.collect_set(F.when(counts, turn)))
    runs = transcript.groupBy("run_id").agg(turns.alias("_turns"))

    def used(turns: Column) -> Column:
        ends = F.array_min(F.transform(F.filter(turns, lambda t: t["n"] == 0), lambda t: t["step"]))
        before = F.filter(turns, lambda t, i: (t["n"] > 0) & (F.get(turns, i + 1)["step"].isNull() | (F.get(turns, i + 1)["step"] != t["step"])))
        return let(ends, lambda end: F.flatten(F.transform(F.filter(before, lambda t: end.isNull() | (t["step"] < end)), lambda t: t["calls"])))

    return runs.select("run_id", let(F.col("_turns"), used).alias("tool_calls"))


def tool_call_status(
    calls: DataFrame,
    files: DataFrame | None = None,
    tools: list[str] | None = None,
    allowed: list[str] | None = None,
) -> DataFrame:
    """Add ``path`` and ``status`` to tool calls: ``ok`` or the error the tool returned.

    ``files`` (``path``) lists what exists; without it every allowed path does. The checks run in the tool's own
    order: arguments, tool, path, file.
    """
    paths = ALLOWED_PATHS if allowed is None else allowed
    args = F.try_parse_json("args")
    checked = calls.withColumn("_args", args)
    path = F.coalesce(F.try_variant_get("_args", "$.path", "string"), F.lit(""))
    checked = checked.withColumn("path", path)
    exists = F.lit(True)
    if files is not None:
        # Only allowed paths can be "not found": at most as many rows as the parameter has.
        there = files.where(F.col("path").isin(paths)).select("path", F.lit(True).alias("_exists")).distinct()
        checked = checked.join(F.broadcast(there), "path", "left")
        exists = F.col("_exists").isNotNull()
    known = F.col("tool").isin(KNOWN_TOOLS if tools is None else tools)
    permitted = F.col("path").isin(paths)
    is_object = F.try_variant_get("_args", "$", "map<string,variant>").isNotNull()
    status = (
        F.when(F.col("_args").isNull(), MALFORMED_ARGUMENTS)
        .when(~known, F.concat(F.lit(UNKNOWN_TOOL), "tool"))
        .when(~is_object, NO_OBJECT)
        .when(~permitted, F.concat(F.lit(PATH_NOT_ALLOWED), "path"))
        .when(~exists, F.concat(F.lit(FILE_NOT_FOUND), "path"))
        .otherwise("ok")
    )
    return checked.select(*calls.columns, "path", status.alias("status"))


def steps_from_calls(transcript: DataFrame) -> DataFrame:
    """The other way to count: steps are tool calls plus one, the answer is the last text of the model.

    Repeated reports of a turn count its calls once: first the turns are reduced, then the runs.
    """
    is_turn = F.col("role") == "assistant"
    n_calls = F.when(is_turn, F.greatest(F.coalesce(F.size("tool_calls"), F.lit(0)), F.lit(0))).otherwise(0)
    said = F.when(is_turn, F.nullif(F.left("content", F.lit(ANSWER_LENGTH)), F.lit("")))
    short = computed_once(transcript.select("run_id", "step", "ts", n_calls.alias("_n"), said.alias("_text")))
    per_step = short.groupBy("run_id", "step").agg(
        F.max("_n").alias("_calls"),
        F.max_by("_text", F.when(F.col("_text").isNotNull(), F.col("ts"))).alias("_said"),
        F.min("ts").alias("_first"),
        F.max("ts").alias("_last"),
    )
    return per_step.groupBy("run_id").agg(
        answer_text(F.max_by("_said", F.when(F.col("_said").isNotNull(), F.struct("_last", "step")))).alias("answer"),
        (F.sum("_calls") + 1).cast("bigint").alias("steps"),
        seconds_between(F.min("_first"), F.max("_last")).alias("latency"),
    )


def error_answers(runs: DataFrame) -> DataFrame:
    """Runs as ``run_id, answer, latency``: a failure is an answer too, and its time still counts.

    Needs ``answer, error, started, ended``.
    """
    failed = F.concat(F.lit("Error: "), F.col("error"))
    return runs.select(
        "run_id",
        answer_text(F.coalesce(failed, F.col("answer"))).alias("answer"),
        seconds_between(F.col("started"), F.col("ended")).alias("latency"),
    )


def runs_to_results(runs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``results`` array of every run (``framework, passed, latency`` and, where known, ``tokens``, ``input_tokens`` and
    ``output_tokens``).

    One envelope per run of a model under a framework, so the array is made inside the row.
    """
    keep = ["run_id"] if keep is None else keep
    tags = F.create_map().cast("map<string,string>")

    def entry(metric: str, value: Column, unit: str) -> Column:
        return F.when(
            value.isNotNull(),
            F.struct(
                F.col("framework").alias("name"),
                F.lit(metric).alias("metric"),
                value.cast("double").alias("value"),
                F.lit(unit).alias("unit"),
                F.lit(None).cast("double").alias("duration_seconds"),
                tags.alias("tags"),
                F.lit(None).cast("variant").alias("raw"),
            ),
        )

    counted = [c for c in ("tokens", "input_tokens", "output_tokens") if c in runs.columns]
    results = F.array(
        entry("score", F.col("passed").cast("int"), "bool"),
        entry("latency", F.col("latency"), "sec"),
        *[entry(c, F.col(c), "tokens") for c in counted],
    )
    return runs.select(*keep, F.lit("framework-eval").alias("suite"), F.array_compact(results).alias("results"))


def runs_to_envelopes(runs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Agent runs as envelopes, one per run, ready to be validated and stored: ``keep`` and all envelope columns.

    ``runs`` has what :func:`runs_to_results` reads, ``model`` and ``ended``, and may bring the columns of a run's
    context. The time of a run is its end.
    """
    keep = ["run_id"] if keep is None else keep
    context = fill_run_context(runs.drop("suite"))
    rows = runs_to_results(context.drop("suite"), [*keep, "model", *CONTEXT, "ended"])
    return _as_envelopes(rows, keep)


CONTEXT = ["git_sha", "trigger", "pr_number", "system"]


def _as_envelopes(rows: DataFrame, keep: list[str]) -> DataFrame:
    ended = F.date_format(F.to_utc_timestamp("ended", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    parts = {"timestamp": ended, "model": F.col("model"), "results": F.col("results"), "problems": F.array().cast("array<string>")}
    columns = assemble_envelopes(parts, F.lit(True))
    return rows.select(*keep, *[columns[c].alias(c) for c in ENVELOPE_COLUMNS])


def framework_envelopes(runs: DataFrame, most_runs: int = MOST_RUNS) -> DataFrame:
    """One envelope per model and framework: the results of all its runs in order of their ends, each tagged ``run_id``.

    ``runs`` is as for :func:`runs_to_envelopes`. A pair with more than ``most_runs`` runs has several envelopes of at most so
    many, numbered by ``part`` from 0, as a document has to stay of a size that can be read: no group is larger, however
    many runs a pair has. Time and context of an envelope are those of its last run.
    """
    context = fill_run_context(runs.drop("suite"))
    entries = runs_to_results(context.drop("suite"), ["run_id", "model", "framework", *CONTEXT, "ended"])
    plain = ["name", "metric", "value", "unit", "duration_seconds"]  # what can be put in order
    entries = entries.withColumn("results", F.transform("results", lambda r: F.struct(*[r[c].alias(c) for c in plain])))
    parted = in_parts(entries, ["model", "framework"], ["ended", "run_id"], most_runs)
    newest = F.max(F.struct("ended", "run_id", *CONTEXT))
    runs_of = F.array_sort(F.collect_list(F.struct("ended", "run_id", "results")))
    grouped = parted.groupBy("model", "framework", "part").agg(runs_of.alias("_runs"), newest.alias("_newest"))

    def whole(run: Column) -> Column:
        tags = F.create_map(F.lit("run_id"), run["run_id"].cast("string"))
        return F.transform(run["results"], lambda r: F.struct(*[r[c].alias(c) for c in plain], tags.alias("tags"), F.lit(None).cast("variant").alias("raw")))

    results = F.flatten(F.transform("_runs", whole))
    rows = grouped.select("model", "framework", "part", "_newest.ended", *[f"_newest.{c}" for c in CONTEXT], F.lit("framework-eval").alias("suite"), results.alias("results"))
    return _as_envelopes(rows, ["framework", "part"])
