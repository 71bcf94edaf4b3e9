"""Newly arrived shards become visible to queries."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from evalspark.schemas import flat_schema
from evalspark.sources.shards import with_derived

REFRESH = "10 minutes"
LATEST_KEYS = ["suite", "name", "metric", "model"]


def stream_results(spark: SparkSession, path: str, schema: T.StructType | None = None, **options: str) -> DataFrame:
    """The result dataset as a stream of arriving shards; the same columns as the batch reader gives."""
    reader = spark.readStream.schema(schema or flat_schema()).options(**options)
    return with_derived(reader.parquet(path))


def latest_stream(rows: DataFrame) -> DataFrame:
    """Newest score per (suite, task, metric, model), kept up to date.

    The state is one row per key. A late file loses by its own time, so no watermark is needed, and seeing a shard
    twice does not change a maximum.
    """
    recency = F.struct(F.col("timestamp").isNull(), F.col("timestamp"), F.col("shard_key"), F.col("value"))
    scored = F.when(F.col("value").isNotNull(), recency)
    present = rows.where(" AND ".join(f"`{k}` IS NOT NULL" for k in LATEST_KEYS))
    return present.groupBy(*LATEST_KEYS).agg(
        F.max_by("value", scored).alias("value"),
        F.max_by("timestamp", F.when(F.col("timestamp").isNotNull(), recency)).alias("timestamp"),
    )


def start_latest(rows: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Maintain the latest scores under ``path`` as a log of changed keys, one directory per micro-batch.

    A micro-batch that is run again after a failure overwrites its own directory, so the log holds it once.
    """

    def log_changes(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")

    writer = latest_stream(rows).writeStream.outputMode("update").foreachBatch(log_changes)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=REFRESH)
    return writer.start()


_LOG = "suite STRING, name STRING, metric STRING, model STRING, value DOUBLE, timestamp TIMESTAMP"


def _last(rows: DataFrame, column: str) -> int:
    """The greatest of a partition column, from the names of the directories; -1 where there is none."""
    found = rows.agg(F.max(column)).first()[0]
    return -1 if found is None else found


def _log(spark: SparkSession, path: str, column: str) -> DataFrame:
    try:
        return spark.read.schema(f"{_LOG}, {column} BIGINT").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{_LOG}, {column} BIGINT")


def _state(spark: SparkSession, path: str, at: int | None = None) -> DataFrame:
    snapshots = _log(spark, f"{path}/snapshots", "upto")
    upto = _last(snapshots, "upto")
    base = snapshots.where(F.col("upto") == upto).withColumnRenamed("upto", "batch_id")
    changes = _log(spark, f"{path}/changes", "batch_id").where(F.col("batch_id") > upto)
    rows = base.unionByName(changes if at is None else changes.where(F.col("batch_id") <= at))
    newest = F.max_by(F.struct("value", "timestamp"), "batch_id")
    return rows.groupBy(*LATEST_KEYS).agg(newest.alias("s")).select(*LATEST_KEYS, "s.value", "s.timestamp")


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """Current state of the log: the last snapshot, and the last change of every key since."""
    return _state(spark, path)


def snapshot_latest(spark: SparkSession, path: str) -> None:
    """Write the current state as a snapshot. From then on readers open it and the changes after it, however long the log
    is; older directories may be deleted. Without new changes nothing is written."""
    upto = _last(_log(spark, f"{path}/changes", "batch_id"), "batch_id")
    if upto > _last(_log(spark, f"{path}/snapshots", "upto"), "upto"):
        # Read up to the batch that names the snapshot: a batch that ends meanwhile is left to the changes after it.
        _state(spark, path, upto).write.mode("overwrite").parquet(f"{path}/snapshots/upto={upto}")
