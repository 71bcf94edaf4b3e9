"""Raw documents to envelopes: run context, dispatch by tool kind, assembly."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.functions.let import computed_once
from evalspark.functions.maps import empty_string_map, last_wins
from evalspark.operators import serving, task_eval
from evalspark.schemas import ENVELOPE_COLUMNS, GEN_KWARGS_DDL, SCHEMA_VERSION, SNAPSHOT_DDL, SYSTEM_DDL, SYSTEM_FIELDS

NOT_JSON = "not valid JSON"

# Columns a run may bring along, with their types; absent ones are added as NULL.
CONTEXT_COLUMNS = {
    "suite": "string",
    "model": "string",
    "git_sha": "string",
    "trigger": "string",
    "pr_number": "bigint",
    "timestamp_override": "string",
    "system": SYSTEM_DDL,
    "extra_tags": "map<string,string>",
}


def parse_tag_pairs(df: DataFrame, pairs: str, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """``KEY=VALUE`` strings of each row to a ``tags`` map, and one row per pair that is none.

    The split is at the first ``=``; a later pair with the same key wins. A row with a bad pair has no tags.
    """
    col = F.coalesce(F.col(pairs), F.array().cast("array<string>"))

    def problem(p: Column) -> Column:
        return F.when(~p.contains("="), "expected KEY=VALUE").when(p.startswith("="), "empty key")

    entries = F.transform(
        col,
        lambda p: F.struct(
            F.substring_index(p, "=", 1).alias("key"),
            F.substring(p, F.locate("=", p) + 1, F.length(p)).alias("value"),
        ),
    )
    bad = F.filter(col, lambda p: problem(p).isNotNull())
    checked = df.withColumn("_bad", bad)
    good = checked.where(F.size("_bad") == 0).select(*keep, last_wins(entries).alias("tags"))
    rejects = checked.select(*keep, F.explode_outer("_bad").alias("pair")).where(F.col("pair").isNotNull())
    return good, rejects.withColumn("reason", problem(F.col("pair")))


def system_struct(df: DataFrame) -> Column:
    """``system`` with all fields of the schema; those the column lacks, or a NULL system, give NULL fields."""
    given = df.schema["system"].dataType.fieldNames()
    unknown = sorted(set(given) - {name for name, _ in SYSTEM_FIELDS})
    if unknown:
        raise ValueError(f"unknown system fields: {', '.join(unknown)}")
    fields = [F.col(f"system.{n}") if n in given else F.lit(None) for n, _ in SYSTEM_FIELDS]
    return F.struct(*[f.alias(n) for f, (n, _) in zip(fields, SYSTEM_FIELDS, strict=True)]).cast(SYSTEM_DDL)


def fill_run_context(df: DataFrame, runs: DataFrame | None = None, on: str = "run_id") -> DataFrame:
    """Attach the run dimension and its defaults.

    ``runs`` has one row per run; it is left to the optimizer whether it is small enough to broadcast.
    Without a known revision ``git_sha`` is ``unknown`` and without a probe ``system`` is an empty object; both
    are kept so that validation can report them.
    """
    if runs is not None:
        df = df.join(runs, on, "left")
    for name, kind in CONTEXT_COLUMNS.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df.withColumns(
        {
            "trigger": F.coalesce("trigger", F.lit("local")),
            "git_sha": F.coalesce("git_sha", F.lit("unknown")),
            "system": system_struct(df),
            "extra_tags": F.coalesce("extra_tags", empty_string_map()),
        }
    )


def assemble_envelopes(parts: dict[str, Column], readable: Column | None = None) -> dict[str, Column]:
    """Envelope columns of a document from what its converter read. No measurements is a valid envelope."""
    readable = F.col("doc").isNotNull() if readable is None else readable
    unreadable = F.when(~readable, F.array(F.lit(NOT_JSON)))
    envelope = {
        "schema_version": F.lit(SCHEMA_VERSION),
        "git_sha": F.col("git_sha"),
        "trigger": F.col("trigger"),
        "pr_number": F.col("pr_number").cast("bigint"),
        "suite": F.col("suite"),
        "model_revision": F.lit(None).cast("string"),
        "quantization": F.lit(None).cast("string"),
        "skipped": F.lit(None).cast("boolean"),
        "seed": F.lit(None).cast("bigint"),
        "gen_kwargs": F.lit(None).cast(GEN_KWARGS_DDL),
        "system": F.col("system"),
        "memory_snapshots": F.lit(None).cast(f"array<{SNAPSHOT_DDL}>"),
        "errors": F.array().cast("array<string>"),
        **parts,
        "problems": F.coalesce(unreadable, parts["problems"]),
    }
    return {c: envelope[c] for c in ["problems", *ENVELOPE_COLUMNS]}


def task_eval_parts(ingest_ts: Column, tags: Column | None) -> dict[str, Column]:
    top, cfg, gen, args = (F.col(c) for c in ("_top", "_cfg", "_gen", "_args"))
    return {
        "timestamp": task_eval.extract_timestamp(F.col("timestamp_override"), top["date"], ingest_ts),
        "model": task_eval.resolve_model(F.col("model"), top, args),
        "results": task_eval.measurements(top, F.col("_took"), tags),
        "gen_kwargs": task_eval.extract_gen_kwargs(gen),
        "seed": task_eval.extract_seed(cfg),
        "model_revision": task_eval.extract_revision(top, args),
        "problems": task_eval.shape_problems(),
    }


def serving_parts(ingest_ts: Column, tags: Column | None) -> dict[str, Column]:
    """Serving runs state no date, seed, revision or generation settings."""
    top, args = F.col("_top"), F.col("_args")
    no_date = F.lit(None).cast("variant")
    return {
        "timestamp": task_eval.extract_timestamp(F.col("timestamp_override"), no_date, ingest_ts),
        "model": task_eval.resolve_model(F.col("model"), top, args),
        "results": serving.measurements(top, tags),
        "problems": serving.shape_problems(),
    }


@dataclass(frozen=True)
class Converter:
    """Column expressions over an opened document: tags of the run, and the parts of its envelope."""

    tags: Callable[[], Column]
    parts: Callable[[Column, Column | None], dict[str, Column]]


CONVERTERS = {
    "lm-eval": Converter(
        lambda: task_eval.run_tags(F.col("extra_tags"), F.col("_top"), F.col("_cfg"), F.col("_gen")), task_eval_parts
    ),
    "vllm": Converter(lambda: serving.serving_tags(F.col("extra_tags"), F.col("_top")), serving_parts),
}


def get_converter(kind: str) -> Converter:
    converter = CONVERTERS.get(kind)
    if converter is None:
        raise ValueError(f"there is no converter for {kind!r}, only for {' and '.join(CONVERTERS)}")
    return converter


def convert(
    docs: DataFrame, kind: str | Column, keep: list[str], ingest_ts: Column | None = None,
    columns: list[str] | None = None, with_tags: bool = True,
) -> DataFrame:
    """``keep``, ``problems`` and the envelope columns of parsed documents.

    ``columns`` names the envelope columns that are wanted, and without ``with_tags`` the measurements have none: what is
    not asked for is not in the plan. The barrier that follows a conversion would keep it there.

    Needs ``doc`` (NULL where the text was not JSON) and the columns of :func:`fill_run_context`. ``kind`` names the
    tool, or is a column when one input mixes tools: the converters then share one pass over it, and a row of an
    unknown kind gets an empty envelope with the problem noted. A non-empty ``problems`` marks a document that could
    not be read as its kind; :func:`split_converted` separates those.
    """
    ts = F.current_timestamp() if ingest_ts is None else ingest_ts
    opened = task_eval.open_document(docs)
    wanted = [c for c in ENVELOPE_COLUMNS if columns is None or c in columns]
    tags = F.col("_tags") if with_tags else None
    if isinstance(kind, str):
        converter = get_converter(kind)
        made = assemble_envelopes(converter.parts(ts, tags))
        tagged = opened.withColumn("_tags", converter.tags()) if with_tags else opened
        return tagged.select(*keep, *[made[name].alias(name) for name in ["problems", *wanted]])
    tagged = opened
    if with_tags:
        tagged = opened.withColumn("_tags", _by_kind(kind, {n: c.tags() for n, c in CONVERTERS.items()}))
    each = {n: assemble_envelopes(c.parts(ts, tags)) for n, c in CONVERTERS.items()}
    chosen = {c: _by_kind(kind, {n: each[n][c] for n in each}) for c in wanted}
    unknown = F.array(F.concat(F.lit("unknown converter kind: "), F.coalesce(kind, F.lit("(none)"))))
    problems = F.coalesce(_by_kind(kind, {n: each[n]["problems"] for n in each}), unknown)
    return tagged.select(*keep, problems.alias("problems"), *[c.alias(name) for name, c in chosen.items()])


def _by_kind(kind: Column, choices: dict[str, Column]) -> Column:
    """The expression of the row's kind; NULL for an unknown one. Equal expressions are stated once."""
    if len({str(c) for c in choices.values()}) == 1:
        return F.when(kind.isin(*choices), next(iter(choices.values())))
    return F.coalesce(*[F.when(kind == name, c) for name, c in choices.items()])


def split_converted(converted: DataFrame, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """``(envelopes, rejects)``: a document with problems is not published, its problems are listed."""
    done = computed_once(converted)
    good = done.where(F.size("problems") == 0).drop("problems")
    bad = done.where(F.size("problems") > 0)
    return good, bad.select(*keep, F.array_join("problems", "; ").alias("reason"))
