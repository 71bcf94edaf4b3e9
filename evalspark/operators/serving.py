"""Serving-benchmark documents to measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.functions import variants as V
from evalspark.functions.let import let
from evalspark.functions.maps import overlay
from evalspark.operators.task_eval import not_objects
from evalspark.schemas import SERVING_COUNTER_TAGS, SERVING_METRICS

RESULT_NAME = "benchmark_serving"


def serving_tags(extra_tags: Column, top: Column) -> Column:
    """Caller's tags plus the run's counters as whole numbers (fractions cut off)."""
    counters = F.array(
        *[F.struct(F.lit(tag).alias("key"), top[key].alias("value")) for key, tag in SERVING_COUNTER_TAGS.items()]
    )

    def whole(v: Column, t: Column) -> Column:
        as_written = F.when(V.integer_literal_kind(t), F.try_variant_get(v, "$", "string"))
        return F.coalesce(as_written, V.numeric_or_bool(v, t).try_cast("bigint").cast("string"))

    read = F.transform(
        counters,
        lambda c: F.struct(c["key"].alias("key"), let(V.kind(c["value"]), lambda t: whole(c["value"], t)).alias("value")),
    )
    known = F.map_from_entries(F.filter(read, lambda c: c["value"].isNotNull()))
    return let(known, lambda k: overlay(extra_tags, k))


def serving_duration(top: Column) -> Column:
    return let(top["duration"], V.numeric_or_bool)


def known_metrics() -> Column:
    """The metric table as a literal array."""
    return F.array(
        *[
            F.struct(F.lit(key).alias("key"), F.lit(metric).alias("metric"), F.lit(unit).alias("unit"))
            for key, (metric, unit) in SERVING_METRICS.items()
        ]
    )


def measurements(top: Column, tags: Column | None) -> Column:
    """The ``results`` array: one entry for each known key with a number."""

    def read(known: Column) -> Column:
        return F.struct(known.alias("known"), let(top[known["key"]], V.numeric_or_bool).alias("value"))

    def result(m: Column, run: Column) -> Column:
        return F.struct(
            F.lit(RESULT_NAME).alias("name"),
            m["known"]["metric"].alias("metric"),
            m["value"].alias("value"),
            m["known"]["unit"].alias("unit"),
            run["seconds"].alias("duration_seconds"),
            run["tags"].alias("tags"),
            F.lit(None).cast("variant").alias("raw"),
        )

    present = F.filter(F.transform(known_metrics(), read), lambda m: m["value"].isNotNull())
    run = F.struct(serving_duration(top).alias("seconds"), (F.lit(None).cast("map<string,string>") if tags is None else tags).alias("tags"))
    return let(run, lambda r: F.transform(present, lambda m: result(m, r)))


def unpivot_serving_metrics(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row per known metric of each document: ``name, metric, value, unit`` next to ``keep``."""
    top = F.coalesce(V.fields(F.col("doc")), V.no_fields())
    opened = df.withColumn("_top", top)
    rows = opened.select(*keep, "_top", F.explode(known_metrics()).alias("m"))
    return rows.select(
        *keep,
        F.lit(RESULT_NAME).alias("name"),
        F.col("m.metric").alias("metric"),
        V.numeric_or_bool(F.col("_top")[F.col("m.key")]).alias("value"),
        F.col("m.unit").alias("unit"),
    ).where(F.col("value").isNotNull())


def shape_problems() -> Column:
    """Reasons why a parsed document cannot be read; reads ``doc`` and the columns of ``open_document``."""
    not_a_document = F.when(V.fields(F.col("doc")).isNull(), "document is not an object")
    parts = {"config": F.col("_top")["config"], "config.model_args": F.col("_cfg")["model_args"]}
    return F.concat(F.array_compact(F.array(not_a_document)), not_objects(parts))
