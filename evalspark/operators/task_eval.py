"""Task-evaluation documents to measurements.

Everything stays inside the row of its document: ``results`` is an object of objects, read as nested maps,
so building the list of measurements needs no explode, no regrouping and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.functions import variants as V
from evalspark.functions.let import let
from evalspark.functions.maps import overlay
from evalspark.schemas import GEN_KWARGS_DDL, TASK_METRIC_NAMES

ISO_UTC = r"(?dU)\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?Z$"
# First and last second with a four-digit year; the source tool cannot print others.
MIN_EPOCH, MAX_EPOCH = -62135596800, 253402300799


def open_document(df: DataFrame) -> DataFrame:
    """Add the objects the other functions read: ``_top _cfg _gen _args _took``."""
    df = df.withColumn("_top", F.coalesce(V.fields(F.col("doc")), V.no_fields()))
    df = df.withColumn("_cfg", F.coalesce(V.fields(F.col("_top")["config"]), V.no_fields()))
    return df.withColumns(
        {
            "_gen": F.coalesce(V.fields(F.col("_cfg")["gen_kwargs"]), V.no_fields()),
            "_args": F.coalesce(V.fields(F.col("_cfg")["model_args"]), V.no_fields()),
            "_took": F.coalesce(V.fields(F.col("_top")["total_evaluation_time_seconds_per_task"]), V.no_fields()),
        }
    )


def explode_task_metrics(df: DataFrame) -> DataFrame:
    """One row per (task, metric key): ``task, metric_key, metric_value`` next to the other columns."""
    tasks = df.withColumn("_tasks", V.fields(V.fields(F.col("doc"))["results"]))
    per_task = tasks.select(*df.columns, F.explode_outer("_tasks").alias("task", "_metrics"))
    return (
        per_task.select(
            *df.columns,
            "task",
            F.explode_outer(V.fields(F.col("_metrics"))).alias("metric_key", "metric_value"),
        )
        # The outer form keeps the optimizer from repeating the parse in an inferred filter below the explode.
        .where(F.col("metric_key").isNotNull())
    )


def is_measurement(metric_key: Column, metric_value: Column) -> Column:
    """Error estimates, the display name and everything that is not a number go. Booleans stay as 1 or 0."""
    label = metric_key.contains("stderr") | (metric_key == "alias")
    return ~label & V.numeric_or_bool(metric_value).isNotNull()


def rename_metric(metric_key: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in TASK_METRIC_NAMES.items() for x in pair])
    return F.coalesce(known[metric_key], F.translate(metric_key, ",", "_"))


def infer_unit(metric: Column) -> Column:
    return (
        F.when(metric.isin(*TASK_METRIC_NAMES.values()), "ratio")
        .when(metric.endswith("_seconds"), "seconds")
        .when(metric.endswith("_ms"), "ms")
        .otherwise("ratio")
    )


def run_tags(extra_tags: Column, top: Column, cfg: Column, gen: Column) -> Column:
    """Tags that are the same for every measurement of a run; those the document states override the caller's."""
    stated = F.array(
        F.struct(F.lit("total_eval_time_s").alias("key"), top["total_evaluation_time_seconds"].alias("value")),
        F.struct(F.lit("n_limit").alias("key"), cfg["limit"].alias("value")),
        F.struct(F.lit("max_gen_toks").alias("key"), gen["max_gen_toks"].alias("value")),
    )
    present = F.filter(stated, lambda e: ~V.absent(e["value"]))
    texts = F.map_from_entries(F.transform(present, lambda e: F.struct(e["key"], V.text(e["value"]))))
    return let(texts, lambda t: overlay(extra_tags, t))


def measurement_tags(metric_key: Column, tags: Column) -> Column:
    # An overlay of a single entry: it stays unless the tags have its key.
    return F.when(F.map_contains_key(tags, "lm_eval_key"), tags).otherwise(F.map_concat(F.create_map(F.lit("lm_eval_key"), metric_key), tags))


def task_duration(took: Column, task: Column) -> Column:
    """Seconds spent on a task; zero counts, text does not."""
    return let(took[task], V.numeric_or_bool)


def measurements(top: Column, took: Column, tags: Column | None) -> Column:
    """The ``results`` array of a document; without ``tags`` its measurements have none."""
    no_tags = F.lit(None).cast("map<string,string>")

    def candidates(metrics: Column) -> Column:
        """Numeric members of a task's metrics, in stages so that each value is looked at once."""
        named = F.filter(F.map_entries(metrics), lambda m: ~(m["key"].contains("stderr") | (m["key"] == "alias")))
        read = F.transform(
            named,
            lambda m: F.struct(
                m["key"].alias("key"),
                rename_metric(m["key"]).alias("metric"),
                let(V.kind(m["value"]), lambda t: V.numeric_or_bool(m["value"], t)).alias("value"),
            ),
        )
        return F.filter(read, lambda m: m["value"].isNotNull())

    def result(task: Column, m: Column, seconds: Column) -> Column:
        return F.struct(
            task.alias("name"),
            m["metric"].alias("metric"),
            m["value"].alias("value"),
            infer_unit(m["metric"]).alias("unit"),
            seconds.alias("duration_seconds"),
            (no_tags if tags is None else measurement_tags(m["key"], tags)).alias("tags"),
            F.lit(None).cast("variant").alias("raw"),
        )

    def of_task(task: Column, metrics: Column) -> Column:
        kept = candidates(F.coalesce(metrics, V.no_fields()))
        return let(task_duration(took, task), lambda seconds: F.transform(kept, lambda m: result(task, m, seconds)))

    tasks = F.coalesce(F.map_entries(V.fields_of_fields(top["results"])), F.array())
    return F.flatten(F.transform(tasks, lambda t: of_task(t["key"], t["value"])))


def extract_timestamp(override: Column, date: Column, ingest_ts: Column) -> Column:
    """Run time as UTC text: the caller's, the document's (epoch seconds or ISO text), else ``ingest_ts``."""
    utc = "yyyy-MM-dd'T'HH:mm:ss'Z'"

    def stated(d: Column) -> Column:
        micros = F.rint(V.numeric_or_bool(d) * 1e6).try_cast("bigint")
        iso = let(V.string(d), lambda s: F.when(s.rlike(ISO_UTC), s))
        return F.coalesce(F.date_format(F.timestamp_micros(micros), utc), iso)

    return F.coalesce(F.nullif(override, F.lit("")), let(date, stated), F.date_format(ingest_ts, utc))


def extract_gen_kwargs(gen: Column) -> Column:
    values = F.struct(
        V.integer_literal(gen["max_gen_toks"]).alias("max_gen_toks"),
        let(gen["temperature"], V.numeric_or_bool).alias("temperature"),
        let(gen["top_p"], V.numeric_or_bool).alias("top_p"),
        V.integer_literal(gen["top_k"]).alias("top_k"),
    )
    names = ("max_gen_toks", "temperature", "top_p", "top_k")
    some = let(values, lambda g: F.when(F.coalesce(*[g[n].cast("double") for n in names]).isNotNull(), g))
    return some.cast(GEN_KWARGS_DDL)


def extract_seed(cfg: Column) -> Column:
    return V.integer_literal(cfg["seed"])


def extract_revision(top: Column, args: Column) -> Column:
    """First of the stated source and the pinned revision that is not empty."""
    stated = F.filter(F.array(top["model_source"], args["revision"]), V.truthy)
    return let(F.get(stated, F.lit(0)), V.text)


def resolve_model(override: Column, top: Column, args: Column) -> Column:
    names = F.transform(F.array(top["model_name"], args["model"], top["model"]), V.string)
    first = F.get(F.filter(names, lambda n: n.isNotNull() & (n != "")), F.lit(0))
    return F.coalesce(F.nullif(override, F.lit("")), first, F.lit("unknown"))


def not_objects(parts: dict[str, Column]) -> Column:
    """A reason for each part that is neither missing nor empty nor an object."""
    named = F.array(*[F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in parts.items()])
    bad = F.filter(named, lambda p: ~V.is_object(p["value"]) & V.truthy(p["value"]))
    return F.transform(bad, lambda p: F.concat(p["name"], F.lit(" is not an object")))


def shape_problems() -> Column:
    """Reasons why a parsed document cannot be read as a task evaluation: a part has the wrong type.

    Reads ``doc`` and the columns of :func:`open_document`.
    """
    top, cfg, gen = F.col("_top"), F.col("_cfg"), F.col("_gen")
    parts = {
        "results": top["results"],
        "config": top["config"],
        "config.model_args": cfg["model_args"],
        "config.gen_kwargs": cfg["gen_kwargs"],
        "total_evaluation_time_seconds_per_task": top["total_evaluation_time_seconds_per_task"],
    }
    whole_numbers = {
        "config.seed": cfg["seed"],
        "config.gen_kwargs.max_gen_toks": gen["max_gen_toks"],
        "config.gen_kwargs.top_k": gen["top_k"],
    }
    named = F.array(*[F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in whole_numbers.items()])
    booleans = F.filter(named, lambda p: V.is_boolean(p["value"]))
    wide = F.filter(named, lambda p: p["value"].isNotNull() & V.too_wide(p["value"]))
    tasks = F.try_variant_get(top["results"], "$", "map<string,struct<_: boolean>>")
    bad_tasks = F.coalesce(F.map_keys(F.map_filter(tasks, lambda _, v: v.isNull())), F.array().cast("array<string>"))
    date = let(top["date"], V.numeric_or_bool)
    found = F.array(
        F.when(~V.is_object(F.col("doc")), "document is not an object"),
        let(date, lambda d: F.when((d < MIN_EPOCH) | (d > MAX_EPOCH), "date is out of range")),
    )
    return F.concat(
        F.array_compact(found),
        not_objects(parts),
        F.transform(bad_tasks, lambda t: F.concat(F.lit("metrics are not an object: "), t)),
        F.transform(booleans, lambda p: F.concat(p["name"], F.lit(" is a boolean"))),
        F.transform(wide, lambda p: F.concat(p["name"], F.lit(" does not fit 64 bits"))),
    )
