"""The result dataset as stored: Parquet shards, read under one explicit schema."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalspark.functions.names import short_model
from evalspark.functions.times import instant
from evalspark.schemas import RESULT_COLUMNS_DDL, flat_schema
from evalspark.sources import commits as CM


def empty_results(spark: SparkSession, schema: T.StructType | None = None) -> DataFrame:
    """The dataset before the first shard: no rows, every column a query may use."""
    if schema is None:
        return spark.createDataFrame([], RESULT_COLUMNS_DDL)
    return with_derived(spark.createDataFrame([], schema))


def with_derived(df: DataFrame) -> DataFrame:
    """``timestamp`` as an instant, where a shard holds text, and ``model_short``."""
    if isinstance(df.schema["timestamp"].dataType, T.StringType):
        df = df.withColumn("timestamp", instant(F.col("timestamp")))
    return df.withColumn("model_short", short_model(F.col("model")))


def read_shards(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    keep_batch: bool = False,
    suites: list[str] | None = None,
    days: tuple[date, date] | None = None,
) -> DataFrame:
    """All shards under ``path``, united by column name; a column a shard lacks is NULL there.

    The schema is given, not merged from the files: a column that was all NULL in one run is stored with a
    made-up type and would not merge. It also spares a job over the footers of every shard. A path that does
    not exist yet is an empty dataset. ``keep_batch`` adds the batch that stored a row.

    Of a store only batches that are committed count. With ``suites``, or first and last of the ``days``, rows of those are
    read, and rows without a time; batches that have none by their manifests are not even listed.
    """
    schema = schema or flat_schema()
    batched = T.StructType([*schema.fields, T.StructField("batch_id", T.StringType())])
    batches = CM.live_batches(spark, path)
    if batches is None:
        found = CM.read_or_none(spark, path, batched)
    else:
        found = CM.read_batches(spark, path, batched, [b.name for b in batches.values() if b.may_have(suites, days)])
    if found is None:
        return empty_results(spark, batched if keep_batch else schema)
    rows = with_derived(found)
    if suites is not None:
        rows = rows.where(F.col("suite").isin(list(suites)))
    if days is not None:
        first, after = (F.lit(d).cast("timestamp") for d in (days[0], date.fromordinal(days[1].toordinal() + 1)))
        rows = rows.where(F.col("timestamp").isNull() | ((F.col("timestamp") >= first) & (F.col("timestamp") < after)))
    return rows if keep_batch else rows.drop("batch_id")
