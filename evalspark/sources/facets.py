"""Index of the values in use: per batch the distinct suites, tasks, metrics, models and tag keys with their rows.

Facets, the keys that tags have, the columns of a pivot and the counts of a dataset are read from here. The index grows
with the values, not with the rows; of the rows of a batch it is made once, when they are stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalspark.functions.names import short_model
from evalspark.operators.results import DEFAULT_TREND_MODELS, _preferred_or_first, PREFERRED_METRIC, PREFERRED_SUITE
from evalspark.schemas import flat_schema
from evalspark.sources import commits as CM

FACETS_DDL = "suite STRING, facet STRING, metric STRING, value STRING, n BIGINT, batch_id STRING"
FACETS = ("suite", "name", "metric", "model")
TAG = "tag"
#: Tasks by metric: what a pivot of one suite and metric has as columns.
TASK_OF_METRIC = "name of metric"


def write_facets(spark: SparkSession, path: str, batch: str) -> None:
    """The index of a batch from the rows it has stored: five columns of them, one aggregation with partial sums."""
    schema = T.StructType([*flat_schema().fields, T.StructField("batch_id", T.StringType())])
    rows = CM.read_one(spark, path, schema, batch)
    if rows is None:
        return
    # Values by grouping sets and keys of tags apart: an array of all of them in every row takes several times as long.
    sets = [["suite"], *[["suite", c] for c in FACETS[1:]], ["suite", "metric", "name"]]
    grouped = rows.groupingSets([[F.col(c) for c in of] for of in sets], *[F.col(c) for c in FACETS])
    sums = grouped.agg(F.count(F.lit(1)).alias("n"), *[(F.grouping(c) == 0).alias(f"_{c}") for c in FACETS[1:]])
    facet = F.when(F.col("_name") & F.col("_metric"), TASK_OF_METRIC)
    value = F.when(F.col("_name"), F.col("name"))
    for c in FACETS[1:]:
        facet = facet.when(F.col(f"_{c}"), c)
        value = value if c == "name" else value.when(F.col(f"_{c}"), F.col(c))
    facet, value = facet.otherwise("suite"), value.otherwise(F.col("suite"))
    metric = F.when(F.col("_name") & F.col("_metric"), F.col("metric"))
    values = sums.select("suite", facet.alias("facet"), metric.alias("metric"), value.alias("value"), "n")
    keys = rows.select("suite", F.explode(F.map_keys("tags")).alias("value")).groupBy("suite", "value").agg(F.count(F.lit(1)).alias("n"))
    tags = keys.select("suite", F.lit(TAG).alias("facet"), F.lit(None).cast("string").alias("metric"), "value", "n")
    found = values.unionByName(tags).coalesce(1)
    found.write.mode("overwrite").parquet(f"{path}_facets/batch_id={batch}")


def read_facets(spark: SparkSession, path: str) -> DataFrame:
    """(suite, facet, metric, value, n) of the batches that count, one row per batch and value."""
    schema = T.StructType.fromDDL(FACETS_DDL)
    batches = CM.live_batches(spark, path) or {}
    found = CM.read_batches(spark, f"{path}_facets", schema, [b.name for b in batches.values() if b.n_rows])
    return spark.createDataFrame([], schema) if found is None else found


def facets(index: DataFrame, columns: tuple[str, ...] = FACETS, suite: str | None = None) -> DataFrame:
    """``(facet, value)`` as :func:`evalspark.operators.results.facets` gives it, of one suite or of all."""
    chosen = index.where(F.col("facet").isin(*columns) & F.col("value").isNotNull())
    if suite is not None:
        chosen = chosen.where(F.col("suite") == suite)
    return chosen.select("facet", "value").distinct().orderBy("facet", "value")


def tag_keys(index: DataFrame) -> DataFrame:
    """``key``: all keys that tags have."""
    return index.where(F.col("facet") == TAG).select(F.col("value").alias("key")).distinct().orderBy("key")


def pivot_names(index: DataFrame, suite: str, metric: str) -> DataFrame:
    """``name``: the tasks of a suite that have a metric, the columns of its pivot."""
    chosen = index.where((F.col("facet") == TASK_OF_METRIC) & (F.col("suite") == suite) & (F.col("metric") == metric))
    return chosen.where(F.col("value").isNotNull()).select(F.col("value").alias("name")).distinct().orderBy("name")


def dataset_stats(index: DataFrame) -> DataFrame:
    """Rows and distinct models."""
    is_model = F.col("facet") == "model"
    return index.agg(
        F.coalesce(F.sum(F.when(F.col("facet") == "suite", F.col("n"))), F.lit(0)).alias("n_rows"),
        F.countDistinct(F.when(is_model, F.col("value"))).alias("n_models"),
    )


def default_selection(index: DataFrame) -> DataFrame:
    """What a viewer starts with: one row ``suite, task, metric``."""

    def of(facet: str) -> str:
        return F.when(F.col("facet") == facet, F.col("value"))

    wide = index.select(*[of(c).alias(c) for c in ("suite", "name", "metric")])
    return wide.agg(
        F.coalesce(_preferred_or_first("suite", PREFERRED_SUITE), F.lit(PREFERRED_SUITE)).alias("suite"),
        F.min("name").alias("task"),
        _preferred_or_first("metric", PREFERRED_METRIC).alias("metric"),
    )


def first_models(index: DataFrame, n: int = DEFAULT_TREND_MODELS) -> DataFrame:
    """Short names of the first ``n`` models in order of their full names."""
    models = index.where((F.col("facet") == "model") & F.col("value").isNotNull()).select(F.col("value").alias("model")).distinct()
    return models.orderBy("model").limit(n).select("model", short_model(F.col("model")).alias("model_short"))
