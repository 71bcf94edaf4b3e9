"""Session settings and the shared folder for data a job writes between stages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Rendering and parsing of times must not depend on the host's zone; of a repeated key in a document the last value counts.
SETTINGS = {"spark.sql.session.timeZone": "UTC", "spark.sql.variant.allowDuplicateKeys": "true"}


# Of the tables that are written. Digests in hex are the greater part of the keys, and only a codec that codes symbols halves them.
COMPRESSION = "zstd"


def configure(spark: SparkSession) -> SparkSession:
    """The settings this library needs (``SETTINGS``), made where they differ. Nothing else in it changes a session."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, else a folder in the session's warehouse.

    The warehouse is shared by the driver and the executors wherever tables can be stored, so that nothing is ever
    written to a folder that only one machine sees.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return named.rstrip("/") if named else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/evalspark-shared"


def new_shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of its own in the shared folder: computed once, and there still when executors are lost."""
    path = new_shared_path(df.sparkSession, name)
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
