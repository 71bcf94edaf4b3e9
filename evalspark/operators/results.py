"""Queries over the result dataset: latest scores, trends, pivot, facets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evalspark.operators.flatten import column_names
from evalspark.functions.names import score_label

# The selections a fresh viewer starts from.
PREFERRED_SUITE = "reasoning"
PREFERRED_METRIC = "exact_match_flexible"
DEFAULT_TREND_MODELS = 6
NO_DATA = "No data for this selection"
# end of fixed values

TIE_BREAK = ["shard_key", "name", "value"]


def select_results(df: DataFrame, suite: str | None = None, task: str | None = None, metric: str | None = None) -> DataFrame:
    """Rows equal to every given selection. Suite is the partition column, the others reach the Parquet scan."""
    for column, wanted in (("suite", suite), ("name", task), ("metric", metric)):
        if wanted is not None:
            df = df.where(F.col(column) == wanted)
    return df


def _recency(df: DataFrame, tie: list[str]) -> list[Column]:
    # A row without a time sorts after all others and so counts as the newest.
    return [F.col("timestamp").isNull(), F.col("timestamp"), *[F.col(c) for c in tie if c in df.columns]]


def latest(df: DataFrame, keys: list[str], mode: str = "non_null", tie: list[str] | None = None) -> DataFrame:
    """One row per key. Rows with a NULL key are left out.

    ``non_null``: each column holds its newest value that is not NULL, so columns may come from different runs.
    ``row``: the newest row as it is. Equal times are ordered by ``tie``.

    Both reduce on the map side first (partial ``max_by``, partial group limit), so a key with most of the rows
    sends one row per task through the shuffle.
    """
    tie = TIE_BREAK if tie is None else tie
    recency = _recency(df, tie)
    present = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    if mode == "row":
        newest_first = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in recency])
        return present.withColumn("_n", F.row_number().over(newest_first)).where("_n = 1").drop("_n")
    if mode != "non_null":
        raise ValueError(f"unknown mode {mode!r}")
    order = F.struct(*recency)
    rest = [c for c in df.columns if c not in keys]
    return present.groupBy(*keys).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in rest]
    ).select(*df.columns)


def latest_by_model(df: DataFrame, mode: str = "non_null", tie: list[str] | None = None) -> DataFrame:
    return latest(df, ["model"], mode, tie)


def latest_by_model_task(df: DataFrame, mode: str = "non_null", tie: list[str] | None = None) -> DataFrame:
    return latest(df, ["model", "name"], mode, tie)


def leaderboard(df: DataFrame, suite: str, task: str, metric: str, mode: str = "non_null") -> DataFrame:
    """Newest score of each model for one task and metric, lowest first, models without a score last."""
    wanted = ["timestamp", "model", "model_short", "value", *[c for c in TIE_BREAK[:2] if c in df.columns]]
    newest = latest_by_model(select_results(df, suite, task, metric).select(*wanted), mode)
    return newest.select("model", F.col("model_short").alias("label"), "value", "timestamp").orderBy(
        F.col("value").asc_nulls_last(), "label"
    )


def axis_max(df: DataFrame) -> DataFrame:
    """Upper end of a score axis: 15 % above the best score, at least 1."""
    return df.agg(F.greatest(F.lit(1.0), F.coalesce(F.max("value") * 1.15, F.lit(1.0))).alias("axis_max"))


def labelled(df: DataFrame) -> DataFrame:
    return df.withColumn("text", score_label(F.col("value")))


def trend(df: DataFrame, suite: str, task: str, metric: str, models: list[str] | DataFrame | None = None) -> DataFrame:
    """Every run of the chosen models in time order. Choosing none means all of them.

    ``models`` holds short names: a list, or a DataFrame with a ``model_short`` column when there are many.
    """
    chosen = select_results(df, suite, task, metric)
    if isinstance(models, DataFrame):
        chosen = chosen.join(models.select("model_short").distinct(), "model_short", "left_semi")
    elif models:
        chosen = chosen.where(F.col("model_short").isin(list(models)))
    return chosen.select("timestamp", "model_short", "value").orderBy("timestamp")


def round_half_even(value: Column, digits: int) -> Column:
    """Rounding of the scaled value, ties to even. ``round`` and ``bround`` work on the decimal text instead."""
    scale = 10.0**digits
    return F.rint(value * scale) / scale


def summary_pivot(
    df: DataFrame, suite: str, metric: str, names: list[str] | None = None, on_duplicate: str = "error"
) -> DataFrame:
    """Models by tasks with the newest scores, four decimals, one ``Model`` column in front.

    ``names`` are the task columns. Without it they are looked up first; the list is a schema, so it comes to the
    driver. Two models that share a short name have no place in one cell: that is an error, or with
    ``on_duplicate='latest'`` the newer one is shown.
    """
    chosen = select_results(df, suite, metric=metric)
    if names is None:
        names = column_names(chosen.where("name IS NOT NULL").select("name"))
    wanted = ["timestamp", "model", "name", "model_short", "value", *[c for c in TIE_BREAK[:1] if c in df.columns]]
    newest = latest_by_model_task(chosen.select(*wanted))
    if on_duplicate == "error":
        clash = F.raise_error(F.concat(F.lit("two models share the short name "), F.first("model_short")))
        cell = F.when(F.count(F.lit(1)) > 1, clash.cast("double")).otherwise(F.max("value"))
    else:
        cell = F.max_by("value", F.struct(F.col("timestamp").isNull(), "timestamp", "model"))
    return (
        newest.groupBy(F.col("model_short").alias("Model"))
        .pivot("name", names)
        .agg(round_half_even(cell, 4))
        .orderBy("Model")
    )


def or_no_data(df: DataFrame) -> DataFrame:
    """``df``, or for an empty selection one row that says so in ``message``. Never an error."""
    marked = df.withColumn("message", F.lit(None).cast("string"))
    # The count of a bounded probe decides; it reads no more than one row of the selection.
    probe = df.limit(1).agg(F.count(F.lit(1)).alias("n")).where("n = 0")
    notice = probe.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema], F.lit(NO_DATA).alias("message"))
    return marked.unionByName(notice)


def facets(df: DataFrame, columns: tuple[str, ...] = ("suite", "name", "metric", "model")) -> DataFrame:
    """``(facet, value)``: sorted distinct values, without NULL, of every column in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).alias("value")) for c in columns])
    return (
        df.select(F.explode(pairs).alias("p"))
        .select("p.facet", "p.value")
        .where("value IS NOT NULL")
        .distinct()
        .orderBy("facet", "value")
    )


def facets_for_suite(df: DataFrame, suite: str) -> DataFrame:
    """Tasks and metrics of one suite."""
    return facets(select_results(df, suite), ("name", "metric"))


def _preferred_or_first(column: str, preferred: str) -> Column:
    c = F.col(column)
    return F.coalesce(F.max(F.when(c == preferred, c)), F.min(c))


def default_selection(df: DataFrame) -> DataFrame:
    """What a viewer starts with: one row ``suite, task, metric``."""
    return df.agg(
        F.coalesce(_preferred_or_first("suite", PREFERRED_SUITE), F.lit(PREFERRED_SUITE)).alias("suite"),
        F.min("name").alias("task"),
        _preferred_or_first("metric", PREFERRED_METRIC).alias("metric"),
    )


def default_selection_by_suite(df: DataFrame) -> DataFrame:
    """First task and preferred metric for every suite, as shown after a change of suite."""
    return df.where("suite IS NOT NULL").groupBy("suite").agg(
        F.min("name").alias("task"), _preferred_or_first("metric", PREFERRED_METRIC).alias("metric")
    )


def dataset_stats(df: DataFrame) -> DataFrame:
    """Rows and distinct models."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("model").alias("n_models"))


def first_models(df: DataFrame, n: int = DEFAULT_TREND_MODELS) -> DataFrame:
    """Short names of the first ``n`` models in order of their full names."""
    firsts = df.where("model IS NOT NULL").groupBy("model").agg(F.min("model_short").alias("model_short"))
    return firsts.orderBy("model").limit(n)
