"""Which batches of a store count: one manifest per batch, written when everything else of the batch is.

A store is four sibling folders: the rows under ``<path>``, ``<path>_keys`` (a row per run), ``<path>_facets`` (values in
use) and ``<path>_commits``. A batch has a directory of its own in each, and exists for readers, for the comparison with
new batches and for compaction from the moment its manifest is there: whatever a lost driver left half done stays
unseen, and is overwritten if the batch is started again under its name.

A manifest says which suites and days its batch has, so that readers open only the batches they may need, and which
batches a merged one stands for. Manifests are metadata of a few hundred bytes; merging keeps the batches they stand
for few, see :func:`evalspark.sources.store.compact_tiers`.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST_DDL = (
    "batch_id STRING, n_runs BIGINT, n_rows BIGINT, suites ARRAY<STRING>, first_day DATE, last_day DATE, undated BOOLEAN, "
    "level INT, replaces ARRAY<STRING>"
)
# A manifest names at most so many suites; a batch with more may hold any.
MOST_SUITES = 1_000


@dataclass(frozen=True)
class Batch:
    name: str
    n_runs: int
    n_rows: int
    suites: frozenset[str | None] | None  # None: any
    first_day: date | None
    last_day: date | None
    undated: bool
    level: int = 0
    replaces: tuple[str, ...] = field(default=())

    def may_have(self, suites: Iterable[str | None] | None, days: tuple[date, date] | None, undated: bool = True) -> bool:
        """Whether rows of these suites, and of these days or without a day, can be in the batch."""
        if not self.n_rows:
            return False
        if suites is not None and self.suites is not None and not self.suites & set(suites):
            return False
        if days is None or (undated and self.undated):
            return True
        return self.first_day is not None and self.first_day <= days[1] and days[0] <= self.last_day

    def may_share(self, other: Batch) -> bool:
        """Whether the two can have a run in common: equal content has equal suite and time."""
        if self.suites is not None and other.suites is not None and not self.suites & other.suites:
            return False
        if self.undated and other.undated:
            return True
        dated = self.first_day is not None and other.first_day is not None
        return dated and self.first_day <= other.last_day and other.first_day <= self.last_day


def read_or_none(spark: SparkSession, path: str, schema: T.StructType, part: str = "") -> DataFrame | None:
    """The table at ``path``, or a directory of it, or None where it does not exist."""
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/{part}")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def manifests(spark: SparkSession, path: str) -> list[Batch] | None:
    """All manifests, or None where the store has no log of them: it does not exist, or was written before there was one."""
    found = read_or_none(spark, f"{path}_commits", T.StructType.fromDDL(MANIFEST_DDL))
    if found is None:
        return None
    return [
        Batch(r.batch_id, r.n_runs, r.n_rows, None if r.suites is None else frozenset(r.suites), r.first_day, r.last_day, r.undated, r.level, tuple(r.replaces))
        for r in found.collect()
    ]


def live(found: list[Batch]) -> dict[str, Batch]:
    """The batches that count, by name.

    A merged batch stands for those it was made of. Of two merges that share a part, made at the same time, the one whose
    name sorts first counts and the other one is not there; every reader decides alike. Merges of merges come after.
    """
    out = {b.name: b for b in found if not b.replaces}
    for b in sorted((b for b in found if b.replaces), key=lambda b: (b.level, b.name)):
        if all(part in out for part in b.replaces):
            for part in b.replaces:
                del out[part]
            out[b.name] = b
    return out


def live_batches(spark: SparkSession, path: str) -> dict[str, Batch] | None:
    found = manifests(spark, path)
    return None if found is None else live(found)


def unused(spark: SparkSession, path: str) -> list[str]:
    """Names of batches with a manifest that no reader opens: merged into others, or merges that came second. Their
    directories under the store and its keys and facets may be deleted; the manifests have to stay."""
    found = manifests(spark, path) or []
    return sorted({b.name for b in found} - set(live(found)))


def read_batches(spark: SparkSession, folder: str, schema: T.StructType, chosen: Iterable[str]) -> DataFrame | None:
    """Rows of the chosen batches of a folder, or None for none of them. A batch that is not there ends the job."""
    parts = [f"{folder}/batch_id={n}" for n in sorted(chosen)]
    return spark.read.schema(schema).option("basePath", folder).parquet(*parts) if parts else None


def read_one(spark: SparkSession, folder: str, schema: T.StructType, batch: str) -> DataFrame | None:
    """Rows of a batch, or None where nothing of it was written: it had no rows."""
    return read_or_none(spark, folder, schema, f"batch_id={batch}")


@dataclass(frozen=True)
class Statistics:
    """What a manifest says about the runs of a batch."""

    n_runs: int = 0
    n_rows: int = 0
    suites: list[str | None] | None = field(default_factory=list)
    first_day: date | None = None
    last_day: date | None = None
    undated: bool = False


def statistics(keys: DataFrame) -> Statistics:
    """Of runs from their keys (suite, day, n_rows): one aggregation, of which at most ``MOST_SUITES`` rows are looked at."""
    day = F.col("day")
    sums = [
        F.count(F.lit(1)).alias("n_runs"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        F.count_if(day.isNull()).alias("undated"),
    ]
    found = keys.groupBy("suite").agg(*sums).limit(MOST_SUITES + 1).collect()
    suites = [r.suite for r in found]
    if len(found) > MOST_SUITES:
        found, suites = keys.agg(*sums).collect(), None
    days = [d for r in found for d in (r.first_day, r.last_day) if d is not None]
    return Statistics(
        sum(r.n_runs for r in found), sum(r.n_rows for r in found), suites, min(days, default=None), max(days, default=None), any(r.undated for r in found)
    )


def commit(
    spark: SparkSession, path: str, batch: str, stats: Statistics, level: int = 0, replaces: Iterable[str] = (), known: Iterable[str] | None = None
) -> None:
    """Make a batch count. Its manifest is one file, so it is there or it is not.

    A batch that has a manifest is never given another one. A directory that a lost driver left without one is used again.
    ``known`` are the names of the batches with manifests, if they were read just now.
    """
    if batch in ({b.name for b in manifests(spark, path) or []} if known is None else known):
        raise ValueError(f"batch {batch} is committed already")
    schema = T.StructType([f for f in T.StructType.fromDDL(MANIFEST_DDL) if f.name != "batch_id"])
    row = (stats.n_runs, stats.n_rows, stats.suites, stats.first_day, stats.last_day, stats.undated, level, list(replaces))
    spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").parquet(f"{path}_commits/batch_id={batch}")


def ensure_log(spark: SparkSession, path: str) -> None:
    """A log with an empty first manifest, before anything is written: what stands beside a log counts only if it is in it."""
    commit(spark, path, "created", Statistics(), known=())
