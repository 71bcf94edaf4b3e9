"""A corpus from raw documents to shards, in stages that each read what the stage before has kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again. Rows are
told apart by a digest of doc_id and text, so that repeated and null ids do no harm; columns that the stages do not know
pass through.

Each stage keeps what it has no reason to remove: texts without a letter go (language ID), one document of each group of
near duplicates stays (SimHash), documents that hold a window of a benchmark go (decontamination). Mixing puts the rows
in the order of the mixed sequence, which its files keep: they are numbered, and so are the rows in them. Sharding adds
virtual slot and shard and returns the rows shard by shard, within a shard in the order of the files it reads; Spark deals
files to tasks in another order, so it goes by these numbers. Neither removes rows. An empty table passes all stages.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from evalspark.llm import decontaminate, langid, mixing, sharding, simhash
from evalspark.llm.order import row_key, stored
from evalspark.session import configure, new_shared_path

N_SHARDS = 16
_KEY = "__row_key"


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn(_KEY, row_key("doc_id", "text"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language: those without a letter, or null, go. A missing ``lang`` gets the predicted one."""
    columns = docs.columns
    found = langid.predict(docs, langid.learn(docs), keep=tuple(columns), into=("__lang", "__score"))
    found = found.filter(F.col("__lang") != langid.UNKNOWN)
    return found.select(*[F.coalesce("lang", "__lang").alias(c) if c == "lang" else F.col(c) for c in columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least doc_id (then the least digest) stays; of repeated rows one."""
    rows = _keyed(docs)
    groups = simhash.near_duplicates(rows, keep=(_KEY,))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(_KEY).alias("key")))
    kept = groups.groupBy("component").agg(first.alias("first")).select(F.col("first.key").alias(_KEY))
    copy = F.row_number().over(Window.partitionBy(_KEY).orderBy(F.lit(0)))
    return rows.join(kept, _KEY, "left_semi").withColumn("__copy", copy).filter(F.col("__copy") == 1).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    rows = _keyed(docs)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(rows, benchmark, keep=(_KEY,)).filter(F.col("n_hit") > 0).select(_KEY)
    return rows.join(found, _KEY, "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which the sources are mixed; repeated rows stand together."""
    rows = _keyed(docs)
    places = mixing.schedule(rows, keep=(_KEY,)).groupBy(_KEY).agg(F.min("place").alias("__place"))
    return rows.join(places, _KEY).orderBy("__place").select(*docs.columns)


def _as_filed(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with the columns that say where a row stands: file, and row of the file. Rows that come from no files stand
    as they are dealt."""
    try:
        filed = docs.withColumns({"__file": F.col("_metadata.file_name"), "__row": F.col("_metadata.row_index")})
    except AnalysisException:
        return docs.withColumn("__row", F.monotonically_increasing_id()), ["__row"]
    # part-00012-...-c003: partition of the writer, and file of the partition.
    numbers = {"__part": r"part-(\d+)", "__chunk": r"-c(\d+)\."}
    found = {c: F.coalesce(F.regexp_extract("__file", p, 1).try_cast("int"), F.lit(0)) for c, p in numbers.items()}
    return filed.withColumns(found), ["__part", "__chunk", "__file", "__row"]


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their virtual slot (vslot) and shard, by shard and within it in the mixed order."""
    filed, order = _as_filed(docs)
    placed = sharding.place(filed, N_SHARDS, new_shared_path(spark, "slot-map")).drop("rebalanced_shard")
    columns = [c for c in docs.columns if c not in ("vslot", "shard")]
    return placed.orderBy("shard", *order).select(*columns, "vslot", "shard")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("sharding", shards),
]

#: SQL has no XXH64 and no learned language model, so the stages are tested against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
