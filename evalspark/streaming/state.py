"""Latest scores of a store, maintained: what leaderboards are answered from without reading the store.

The state has one row per (suite, task, metric, model) and in it, for every column, the newest value that is not NULL with its
place in time. That makes it a maximum per column: states merge in any order and any number of times, so a micro-batch that
is run again, or rows that are seen twice, change nothing, and Spark keeps no state of its own. A micro-batch reduces
the rows of newly committed batches to such rows and writes them as changes; every so many micro-batches the changes so
far are merged into a snapshot. A reader merges the last snapshot and the changes after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from evalspark.operators.results import TIE_BREAK
from evalspark.schemas import flat_schema
from evalspark.sources import commits as CM
from evalspark.sources.shards import with_derived

REFRESH = "10 minutes"
SNAPSHOT_EVERY = 16
KEYS = ["suite", "name", "metric", "model"]
_RECENCY = "STRUCT<undated: BOOLEAN, timestamp: TIMESTAMP, shard_key: STRING, name: STRING, value: DOUBLE>"


def _columns() -> list[T.StructField]:
    return [f for f in flat_schema() if f.name not in KEYS]


def _schema(part: str) -> T.StructType:
    fields = [T.StructField(k, T.StringType()) for k in KEYS]
    for f in _columns():
        fields += [f, T.StructField(f"at_{f.name}", T.StructType.fromDDL(f"x {_RECENCY}")[0].dataType)]
    return T.StructType([*fields, T.StructField(part, T.LongType())])


def _merged(rows: DataFrame, place: dict[str, Column]) -> DataFrame:
    """One row per key: of every column the value at its greatest place, and that place."""
    parts = []
    for c, at in place.items():
        parts += [F.max_by(c, at).alias(c), F.max(at).alias(f"at_{c}")]
    return rows.groupBy(*KEYS).agg(*parts)


def reduce_rows(rows: DataFrame) -> DataFrame:
    """Flat rows to state rows. Partial maxima leave the tasks, so a key with most of the rows is one row per task."""
    recency = F.struct(F.col("timestamp").isNull().alias("undated"), "timestamp", *TIE_BREAK)
    present = rows.where(" AND ".join(f"`{k}` IS NOT NULL" for k in KEYS))
    return _merged(present, {f.name: F.when(F.col(f.name).isNotNull(), recency) for f in _columns()})


def _merge_states(rows: DataFrame) -> DataFrame:
    return _merged(rows, {f.name: F.col(f"at_{f.name}") for f in _columns()})


def start_state(spark: SparkSession, store: str, path: str, checkpoint: str, once: bool = False, every: int = SNAPSHOT_EVERY, **options: str) -> StreamingQuery:
    """Maintain the state of ``store`` under ``path``.

    What streams are the manifests: rows count, and are read, once their batch is committed, so that a half-done batch is
    never seen and none is missed. Merged batches hold nothing new and are passed over.
    """

    def sink(found: DataFrame, number: int) -> None:
        session = found.sparkSession
        names = [r.batch_id for r in found.where("n_rows > 0 AND size(replaces) = 0").select("batch_id").collect()]
        schema = T.StructType([*flat_schema().fields, T.StructField("batch_id", T.StringType())])
        rows = CM.read_batches(session, store, schema, names)
        if rows is not None:
            reduce_rows(rows).write.mode("overwrite").parquet(f"{path}/changes/number={number}")
        if number % every == every - 1:
            snapshot(session, path, number)

    manifests = spark.readStream.schema(T.StructType.fromDDL(CM.MANIFEST_DDL)).options(**options).parquet(f"{store}_commits")
    writer = manifests.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=REFRESH)
    return writer.start()


def snapshot(spark: SparkSession, path: str, upto: int) -> None:
    """The state after micro-batch ``upto`` as one table; what is older need not be read again."""
    _merge_states(_parts(spark, path, upto)).write.mode("overwrite").parquet(f"{path}/snapshots/upto={upto}")


def _last_snapshot(spark: SparkSession, path: str) -> int:
    found = CM.read_or_none(spark, f"{path}/snapshots", T.StructType([T.StructField("upto", T.LongType())]))
    last = None if found is None else found.agg(F.max("upto")).first()[0]
    return -1 if last is None else last


def _parts(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """State rows whose merger is the state: the last snapshot's, and those of the changes after it."""
    last = _last_snapshot(spark, path)
    plain = _schema("number").names[:-1]
    changes = CM.read_or_none(spark, f"{path}/changes", _schema("number"))
    rows = spark.createDataFrame([], T.StructType(_schema("number").fields[:-1]))
    if last >= 0:
        rows = CM.read_or_none(spark, f"{path}/snapshots", _schema("upto"), f"upto={last}").select(*plain)
    if changes is not None:
        changes = changes.where(F.col("number") > last)
        changes = changes if upto is None else changes.where(F.col("number") <= upto)
        rows = rows.unionByName(changes.select(*plain)) if last >= 0 else changes.select(*plain)
    return rows


def read_state(spark: SparkSession, path: str, suite: str | None = None, task: str | None = None, metric: str | None = None) -> DataFrame:
    """Newest values of every key of a selection: the columns of flat rows, and ``model_short``.

    The selection reaches the files of snapshot and changes, which are small beside the store: a row per key.
    """
    rows = _parts(spark, path)
    for column, wanted in (("suite", suite), ("name", task), ("metric", metric)):
        if wanted is not None:
            rows = rows.where(F.col(column) == wanted)
    return with_derived(_merge_states(rows).select(*flat_schema().names))


def leaderboard(spark: SparkSession, path: str, suite: str, task: str, metric: str) -> DataFrame:
    """The rows of :func:`evalspark.operators.results.leaderboard`, from the state: a key is a model of the selection."""
    newest = read_state(spark, path, suite, task, metric)
    return newest.select("model", F.col("model_short").alias("label"), "value", "timestamp").orderBy(F.col("value").asc_nulls_last(), "label")


def latest_by_model(spark: SparkSession, path: str, suite: str, task: str, metric: str) -> DataFrame:
    return read_state(spark, path, suite, task, metric)


def latest_by_model_task(spark: SparkSession, path: str, suite: str, metric: str) -> DataFrame:
    return read_state(spark, path, suite, metric=metric)
