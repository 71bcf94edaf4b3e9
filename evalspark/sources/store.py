"""Writing the result dataset: content keys, dry run, append once, compaction.

The rows of a batch stand under ``batch_id=<batch>/suite=<suite>``, whether a batch job or a stream wrote them, and one
row per run in a table of keys beside them, ``<path>_keys``, by suite and sorted by day. The batch counts from the moment
its manifest is written, see :mod:`evalspark.sources.commits`. Identity is the full digest of a run's content; the short
digest in the shard's name is for reading.
"""

from __future__ import annotations

import math
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalspark.functions.names import slugify
from evalspark.functions.times import instant
from evalspark.operators.flatten import BASE, OPTIONAL, canonical_results, flatten
from evalspark.schemas import flat_schema
from evalspark.session import COMPRESSION, written
from evalspark.sources import commits as CM
from evalspark.sources import facets as FA
from evalspark.sources.shards import read_shards

NO_ROWS = "the run has no measurement to store"
NO_INSTANT = "the timestamp is no point in time"
NO_KEY = "rows without the key of their content cannot be told apart"
KEYS_DDL = "content_sha STRING, shard_key STRING, batch_id STRING, suite STRING, day DATE, n_rows BIGINT"


def canonical_payload(
    results: Column | None = None, base: list[str] | None = None, system: str = "system"
) -> Column:
    """Content of a run as text: its columns and its measurements in sorted order.

    The bytes of a Parquet file depend on the writer and on how rows fell into tasks; this text does not, so the
    same content always has the same key.
    """
    results = F.col("results") if results is None else results
    system_parts = [F.col(f"{system}.{c}").alias(c) for c in ("os", "chip", "memory_gb")]
    columns = [F.col(c) for c in (BASE + OPTIONAL if base is None else base)]
    return F.to_json(F.struct(*columns, *system_parts, canonical_results(results).alias("results")))


def shard_key(payload: Column | None = None, digest: Column | None = None) -> Column:
    """Path of a run's shard from its envelope columns; with a payload, or its digest, it ends in the content's short digest.

    A name, not an identity: different runs can have the same one.
    """
    when = F.regexp_replace(F.translate("timestamp", ":", "-"), "Z+\\z", "")
    slug = F.left(slugify(F.col("model")), F.lit(50))
    prefix = F.concat(F.lit("data/run-"), F.concat_ws("-", when, F.col("git_sha"), F.col("suite"), slug))
    if digest is None and payload is not None:
        digest = F.sha2(payload, 256)
    if digest is None:
        return F.concat(prefix, F.lit(".parquet"))
    return F.concat(prefix, F.lit("-"), F.left(digest, F.lit(8)), F.lit(".parquet"))


def with_shard_key(envelopes: DataFrame) -> DataFrame:
    """Add ``payload``, ``content_sha`` and ``shard_key``; a narrow step, each run's content is inside its row."""
    keyed = envelopes.withColumn("payload", canonical_payload()).withColumn("content_sha", F.sha2("payload", 256))
    return keyed.withColumn("shard_key", shard_key(digest=F.col("content_sha")))


def no_instant(timestamp: str = "timestamp") -> Column:
    """Whether a time is stated that cannot be stored."""
    return F.col(timestamp).isNotNull() & instant(F.col(timestamp)).isNull()


def split_empty(envelopes: DataFrame, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """``(publishable, rejects)``: a run without a single measurement, or of an impossible time, is refused."""
    reason = F.when(F.coalesce(F.size("results"), F.lit(0)) <= 0, NO_ROWS).when(no_instant(), NO_INSTANT)
    return envelopes.where(reason.isNull()), envelopes.where(reason.isNotNull()).select(*keep, reason.alias("reason"))


def publish_plan(envelopes: DataFrame, keep: list[str]) -> DataFrame:
    """What would be written, for each run: its key, rows and content size. Nothing is written."""
    keyed = with_shard_key(envelopes)
    return keyed.select(
        *keep,
        "shard_key",
        F.size("results").cast("bigint").alias("n_rows"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
    )


def publishable_rows(envelopes: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Flat rows ready to store: with their shard's key, the run's digest and the time as an instant."""
    rows = flatten(with_shard_key(envelopes), [*(keep or []), "shard_key", "content_sha"])
    return rows.withColumn("timestamp", instant(F.col("timestamp")))


def new_batch() -> str:
    return f"batch-{uuid.uuid4().hex}"


def write_rows(
    rows: DataFrame, path: str, batch: str, partition_by: tuple[str, ...] = ("suite",), balanced: bool = False, only: tuple[str, int] | None = None
) -> None:
    """The rows of a batch, one directory per suite. They do not count yet.

    The rebalance hint evens out file sizes: small partitions are joined, and a suite that holds most of the rows
    is spread over many files. A batch that has ``only`` one suite, given with its rows, is not dealt again.
    """
    if only is not None:
        return _write_suite(rows, _emptied(rows, path, batch), *only)
    if not balanced:
        rows = unpacked(packed(rows).hint("rebalance", *[F.col(c) for c in partition_by]))
    _write(rows, f"{path}/batch_id={batch}", partition_by)


def _write(rows: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    rows.write.mode("overwrite").option("compression", COMPRESSION).partitionBy(*partition_by).parquet(path)


# Rows of a file that is written without a shuffle, and of a suite that gets a job of its own.
ROWS_PER_FILE = 500_000
LARGE_SUITE = 250_000
# A suite whose name is that of its directory as it stands.
_PLAIN = re.compile(r"[A-Za-z0-9_-]+")


def only_suite(stats: CM.Statistics) -> str | None:
    """The suite of a batch that has no other, if its directory can be named by it."""
    one = stats.suites[0] if stats.suites is not None and len(stats.suites) == 1 else None
    return one if one is not None and _PLAIN.fullmatch(one) else None


def large_suites(counted: DataFrame, n_rows: str | None = None) -> dict[str, int]:
    """Suites of at least ``LARGE_SUITE`` rows with their rows; ``n_rows`` is the column that counts them, if a row stands for several."""
    n = F.count(F.lit(1)) if n_rows is None else F.sum(n_rows)
    found = counted.groupBy("suite").agg(n.alias("n")).where(F.col("n") >= LARGE_SUITE).orderBy(F.desc("n"), "suite").limit(CM.MOST_SUITES)
    return {r.suite: r.n for r in found.collect() if r.suite is not None and _PLAIN.fullmatch(r.suite)}


def _write_suite(rows: DataFrame, folder: str, suite: str, n_rows: int, sort: tuple[str, ...] = ()) -> None:
    """Rows of one suite as its directory under ``folder``, as they are dealt already: no shuffle deals them to files, and no
    sort by suite comes before the writer."""
    rows = rows.drop("suite").coalesce(max(1, math.ceil(n_rows / ROWS_PER_FILE)))
    _write(rows.sortWithinPartitions(*sort) if sort else rows, f"{folder}/suite={suite}")


def _emptied(rows: DataFrame, path: str, batch: str) -> str:
    """The directory of a batch, without what a lost driver left there."""
    if CM.read_one(rows.sparkSession, path, rows.schema, batch) is not None:
        _write(rows.sparkSession.createDataFrame([], rows.schema), f"{path}/batch_id={batch}", ("suite",))
    return f"{path}/batch_id={batch}"


def _other_than(rows: DataFrame, suites: dict[str, int]) -> DataFrame:
    return rows.where(~F.col("suite").isin(*suites) | F.col("suite").isNull()) if suites else rows


_DIGEST = r"\A[0-9a-f]{64}\z"


def packed(rows: DataFrame) -> DataFrame:
    """``content_sha`` as bytes (``_sha``), half as long, for the way through a shuffle; what is no digest stays as it is."""
    if "content_sha" not in rows.columns:
        return rows
    is_digest = F.regexp_like("content_sha", F.lit(_DIGEST))
    return rows.withColumns({"_sha": F.when(is_digest, F.unhex("content_sha")), "content_sha": F.when(~is_digest, F.col("content_sha"))})


def unpacked(rows: DataFrame) -> DataFrame:
    if "_sha" not in rows.columns:
        return rows
    return rows.withColumn("content_sha", F.coalesce("content_sha", F.lower(F.hex("_sha")))).drop("_sha")


def balanced_rows(runs: DataFrame) -> DataFrame:
    """Rows of envelopes with the digests of :func:`packed`, dealt to files as :func:`write_rows` deals them. Envelopes go through
    the shuffle, not their rows: what the rows of a run share goes once, and the name that follows from it does not go at all."""
    return run_rows(runs.hint("rebalance", F.col("suite")))


def run_rows(runs: DataFrame) -> DataFrame:
    """Rows of envelopes with the digests of :func:`packed`."""
    keyed = unpacked(runs).withColumn("shard_key", shard_key(digest=F.col("content_sha")))
    return flatten(keyed, ["shard_key", "content_sha"]).withColumn("timestamp", instant(F.col("timestamp")))


def write_results(rows: DataFrame, path: str, batch_id: str | None = None, partition_by: tuple[str, ...] = ("suite",)) -> None:
    """Store flat rows as Parquet in the directory of a batch, with their keys, and commit it.

    Rows without ``content_sha`` and ``shard_key`` make a folder of shards that is no store: nothing can be appended to it once.
    """
    spark, batch = rows.sparkSession, batch_id or new_batch()
    if not {"content_sha", "shard_key"} <= set(rows.columns):
        if CM.manifests(spark, path) is not None:
            raise ValueError(NO_KEY)
        return write_rows(rows, path, batch, partition_by)
    start(spark, path)
    write_rows(rows, path, batch, partition_by)
    write_keys(spark, path, batch)
    finish(spark, path, batch)


def start(spark: SparkSession, path: str) -> list[CM.Batch]:
    """Make a store ready for a batch; returns its manifests. A store from before there were manifests gets one for each of
    its batches, and the keys that a batch lacks."""
    found = CM.manifests(spark, path)
    if found is not None:
        return found
    old = CM.read_or_none(spark, path, T.StructType.fromDDL("content_sha STRING, batch_id STRING"))
    before = [] if old is None else [r.batch_id for r in old.select("batch_id").distinct().collect()]
    if None in before:
        raise ValueError(NO_KEY)
    for batch in before:
        write_keys(spark, path, batch)
    CM.ensure_log(spark, path)
    for batch in before:
        finish(spark, path, batch)
    return CM.manifests(spark, path) or []


def finish(
    spark: SparkSession,
    path: str,
    batch: str,
    stats: CM.Statistics | None = None,
    level: int = 0,
    replaces: tuple[str, ...] = (),
    known: set[str] | None = None,
) -> None:
    """Note the values a batch has and commit it: the last steps, when its rows and keys are written. Statistics that are not
    given come from the keys."""
    FA.write_facets(spark, path, batch)
    if stats is None:
        keys = CM.read_one(spark, f"{path}_keys", T.StructType.fromDDL(KEYS_DDL), batch)
        stats = CM.Statistics() if keys is None else CM.statistics(keys)
    CM.commit(spark, path, batch, stats, level, replaces, known)


def distinct_runs(envelopes: DataFrame) -> DataFrame:
    """One envelope per content. The digest is of 256 bits, so equal digests are equal content and any copy may stay.

    A run submitted many times shrinks to one row per task before the shuffle.
    """
    return with_shard_key(envelopes).dropDuplicates(["content_sha"])


def new_runs(envelopes: DataFrame, existing: DataFrame) -> DataFrame:
    """Distinct runs of a batch that are not stored yet."""
    return distinct_runs(envelopes).join(existing.select("content_sha"), "content_sha", "left_anti")


def read_keys(spark: SparkSession, path: str, found: list[CM.Batch] | None = None, of: CM.Statistics | None = None) -> DataFrame:
    """One row per run and batch that stored it, of the batches that count. ``found`` are the manifests, if they were read just
    now; with the statistics ``of`` some runs only batches that may have such runs are opened."""
    schema = T.StructType.fromDDL(KEYS_DDL)
    batches = CM.live((CM.manifests(spark, path) or []) if found is None else found)
    days = (of.first_day, of.last_day) if of and of.first_day is not None else None
    chosen = [b.name for b in batches.values() if b.n_rows and (of is None or b.may_have(of.suites, days, of.undated))]
    found = CM.read_batches(spark, f"{path}_keys", schema, chosen)
    return spark.createDataFrame([], schema) if found is None else found.select(*schema.names)


def stored_keys(keys: DataFrame, runs: DataFrame | None = None, other_than: str | None = None) -> DataFrame:
    """Keys in the store; with ``runs`` only of their suites and days, ``other_than`` leaves one batch out.

    Equal content has equal suite and time, so nothing outside can match: other suites are never opened, and other days
    are skipped by the statistics of the files, which are sorted by day.
    """
    if other_than is not None:
        keys = keys.where(F.col("batch_id") != other_than)
    if runs is None:
        return keys
    day = F.to_date(instant(F.col("timestamp")))
    return _of_suites_and_days(keys, CM.statistics(runs.select("suite", day.alias("day"), F.lit(0).alias("n_rows"))))


def _of_suites_and_days(keys: DataFrame, of: CM.Statistics) -> DataFrame:
    in_days = F.col("day").between(of.first_day, of.last_day) if of.first_day is not None else F.lit(False)
    if of.undated:
        in_days = in_days | F.col("day").isNull()
    if of.suites is not None:
        of_suite = F.col("suite").isin([s for s in of.suites if s is not None])
        in_days = in_days & (of_suite | F.col("suite").isNull() if None in of.suites else of_suite)
    return keys.where(in_days)


def stage(envelopes: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Envelopes with their keys as a table of their own, so that what made them is not run again by each step of an
    append: ``keep``, what flat rows are made of, ``n_rows``, ``payload_bytes`` and a number for each row."""
    keyed = with_shard_key(envelopes)
    results = F.transform("results", lambda r: r.dropFields("raw"))
    machine = F.struct(*[F.col(f"system.{c}").alias(c) for c in ("os", "chip", "memory_gb")])
    return written(
        keyed.select(
            *(keep or []),
            *[c for c in BASE + OPTIONAL if c in keyed.columns],
            machine.alias("system"),
            results.alias("results"),
            "content_sha",
            "shard_key",
            F.coalesce(F.size("results"), F.lit(0)).cast("bigint").alias("n_rows"),
            F.octet_length("payload").cast("bigint").alias("payload_bytes"),
            F.monotonically_increasing_id().alias("_copy"),
        ),
        "staged",
    )


def append_new(envelopes: DataFrame, path: str, batch_id: str | None = None) -> None:
    """Append the runs of a batch the store does not have. Publishing the same content again changes nothing.

    Every batch has a directory of its own, so nothing that another batch wrote is ever touched, and it counts when its
    manifest is written, last. A lost executor is no matter: only the output of a finished job is committed. Nor is a
    lost driver: publish again, and every run is stored once. A ``batch_id`` belongs to one writer; started again it
    takes the place of what it left half done, and adds what is new if it had been committed. Two batches at once may both
    store a run; :func:`compact` and :func:`compact_tiers` keep one.
    """
    append_staged(stage(envelopes), path, batch_id)


def append_staged(staged: DataFrame, path: str, batch_id: str | None = None) -> None:
    """:func:`append_new` of envelopes that :func:`stage` has written, or of some of its rows.

    Copies are found and stored runs left out on narrow keys; the runs themselves meet a join only if some do not stay.
    """
    spark, batch = staged.sparkSession, batch_id or new_batch()
    found = start(spark, path)
    known = {b.name for b in found}
    again = batch in known
    runs = staged.where("n_rows > 0")
    keys = runs.select("content_sha", "_copy", "shard_key", "suite", F.to_date(instant(F.col("timestamp"))).alias("day"), "n_rows")
    stats = of = CM.statistics(keys)
    first = packed(runs.select("content_sha", "_copy")).groupBy("_sha").agg(F.min("_copy").alias("_copy"))
    existing = packed(_of_suites_and_days(read_keys(spark, path, found, of), of).select("content_sha")).where("_sha IS NOT NULL")
    chosen = written(first.join(existing.select("_sha"), "_sha", "left_anti").select("_copy"), "new-runs")
    n_runs = chosen.count()
    if again:
        batch = f"{batch}-{uuid.uuid4().hex}"
    rest = packed(runs).select("_copy", "_sha", "content_sha", *[c for c in BASE + OPTIONAL if c in runs.columns], "system", "results")
    if n_runs != of.n_runs:
        keys = written(keys.join(chosen, "_copy", "left_semi"), "new-keys")
        stats = CM.statistics(keys)
        rest = rest.join(chosen, "_copy", "left_semi")
    if n_runs or not again:
        suite, rest = only_suite(stats), rest.drop("_copy")
        if suite is None:
            write_rows(balanced_rows(rest), path, batch, balanced=True)
        else:
            write_rows(run_rows(rest), path, batch, balanced=True, only=(suite, stats.n_rows))
    if n_runs:
        _write_keys(keys.drop("_copy"), path, batch, stats)
        finish(spark, path, batch, stats, known=known)


def _write_keys(keys: DataFrame, path: str, batch: str, stats: CM.Statistics | None = None) -> None:
    folder, suite = f"{path}_keys/batch_id={batch}", only_suite(stats) if stats else None
    if suite is not None:
        return _write_suite(keys, _emptied(keys, f"{path}_keys", batch), suite, stats.n_runs, ("day",))
    keys = unpacked(packed(keys).hint("rebalance", F.col("suite"))).sortWithinPartitions("suite", "day")
    _write(keys, folder, ("suite",))


def write_keys(spark: SparkSession, path: str, batch: str) -> None:
    """The keys of a batch from the rows it has stored: four columns, one row per run."""
    rows = CM.read_one(spark, path, _stored_schema(), batch)
    if rows is None:
        return
    large = large_suites(rows)
    _write_keys(_keys_of(_other_than(rows, large)), path, batch)
    for suite, n_rows in large.items():
        keys = _keys_of(rows.where(F.col("suite") == suite))
        _write_suite(keys, f"{path}_keys/batch_id={batch}", suite, n_rows, ("day",))


def _keys_of(rows: DataFrame) -> DataFrame:
    day = F.to_date(F.min("timestamp")).alias("day")
    keys = packed(rows).groupBy("_sha", "content_sha", "suite").agg(F.min("shard_key").alias("shard_key"), day, F.count(F.lit(1)).alias("n_rows"))
    return unpacked(keys).withColumn("content_sha", _demanded("content_sha"))


def _demanded(column: str) -> Column:
    return F.coalesce(column, F.raise_error(F.lit(NO_KEY)).cast("string"))


def _stored_schema() -> T.StructType:
    return T.StructType([*flat_schema().fields, T.StructField("batch_id", T.StringType())])


def _each_run_once(rows: DataFrame) -> DataFrame:
    """Stored rows (with ``batch_id``) of each run from one batch: of several the one whose name sorts first.

    Which batch that is comes from the rows themselves, two columns of them, so that rows whose keys were never written
    are not lost; rows that have no key at all end the job.
    """
    chosen = rows.groupBy(_demanded("content_sha").alias("content_sha")).agg(F.min("batch_id").alias("batch_id"))
    return rows.join(chosen, ["content_sha", "batch_id"], "left_semi").drop("batch_id")


def compact(spark: SparkSession, path: str, into: str) -> None:
    """Write the store anew under ``into`` as one batch: few large files, each run once.

    The old store stays as it is; readers and writers are pointed to the new one when it is done.
    """
    rows = read_shards(spark, path, flat_schema(), keep_batch=True).drop("model_short")
    write_results(_each_run_once(rows), into, new_batch())


TIER = 4
SMALLEST_TIER = 100_000


def tier(n_rows: int, fanout: int = TIER) -> int:
    """Size class of a batch: each holds ``fanout`` times the rows of the one below."""
    level = 0
    while n_rows > SMALLEST_TIER * fanout**level:
        level += 1
    return level


def compact_tiers(spark: SparkSession, path: str, fanout: int = TIER) -> int:
    """Merge batches of one size class where there are ``fanout`` of them, until there are fewer; returns the merges.

    A merged batch is of a higher class, so that a row is written again only as often as there are classes, which grow as the logarithm
    of the store, and the batches that a reader lists do so too. Each run is kept once within a merge. Readers see
    the parts until the manifest of the merged batch is there, and it alone from then on, so a merge that is lost half way
    changes nothing. Appends may go on meanwhile.
    """
    start(spark, path)
    merges = 0
    while True:
        found = CM.live_batches(spark, path) or {}
        tiers: dict[int, list[CM.Batch]] = {}
        for b in found.values():
            if b.n_rows:
                tiers.setdefault(max(tier(b.n_rows, fanout), b.level), []).append(b)
        full = [(level, sorted(bs, key=lambda b: b.name)) for level, bs in sorted(tiers.items()) if len(bs) >= fanout]
        if not full:
            return merges
        level, parts = full[0]
        merge(spark, path, [b.name for b in parts], level + 1)
        merges += 1


def merge(spark: SparkSession, path: str, parts: list[str], level: int) -> str:
    """One batch in place of ``parts``, each run once: of several parts that have it, from the one whose name sorts first.

    Only parts that may share runs by their manifests are compared, and rows are joined only of parts that keep some runs and
    lose some. A suite of many rows is written as its files are read; the others are dealt to files by a shuffle. The keys are
    those of the parts.
    """
    batch = f"merged-{uuid.uuid4().hex}"
    parts, keyed = sorted(parts), T.StructType.fromDDL(KEYS_DDL)
    mixed, left_out, chosen = _shared_runs(spark, path, parts)

    def of(folder: str, schema: T.StructType) -> DataFrame:
        whole = CM.read_batches(spark, folder, schema, [p for p in parts if p not in {*mixed, *left_out}])
        rest = CM.read_batches(spark, folder, schema, mixed)
        if rest is not None:
            same = "r._sha <=> c._sha AND r.content_sha <=> c.content_sha AND r.batch_id = c.batch_id"
            rest = unpacked(packed(rest).alias("r").join(chosen.alias("c"), F.expr(same), "left_semi")).select(*schema.names)
        both = [x.drop("batch_id") for x in (whole, rest) if x is not None]
        return both[0] if len(both) == 1 else both[0].unionByName(both[1])

    every = CM.read_batches(spark, path, _stored_schema(), [p for p in parts if p not in left_out])
    rows, large = of(path, _stored_schema()), large_suites(every)
    rows = rows.withColumn("content_sha", _demanded("content_sha"))
    write_rows(_other_than(rows, large), path, batch)
    for suite, n_rows in large.items():
        _write_suite(rows.where(F.col("suite") == suite), f"{path}/batch_id={batch}", suite, n_rows)
    n_rows = CM.read_one(spark, path, _stored_schema(), batch).count()
    keys = of(f"{path}_keys", keyed) if all(CM.read_one(spark, f"{path}_keys", keyed, p) is not None for p in parts) else None
    if keys is None or keys.agg(F.sum("n_rows")).first()[0] != n_rows:  # a part has rows whose keys are not there
        write_keys(spark, path, batch)
    else:
        _write_keys(_other_than(keys, large), path, batch)
        for suite, n_rows in large.items():
            _write_suite(keys.where(F.col("suite") == suite), f"{path}_keys/batch_id={batch}", suite, n_rows, ("day",))
    finish(spark, path, batch, level=level, replaces=tuple(parts))
    return batch


def _shared_runs(spark: SparkSession, path: str, parts: list[str]) -> tuple[list[str], list[str], DataFrame | None]:
    """Of the parts of a merge those of which some runs stay and some are in a part that sorts before, those of which all are,
    and ``chosen``: the runs of the former that stay (``_sha``, ``content_sha``, ``batch_id``).

    Which batch a run is taken from comes from the rows themselves, two columns of them, so that rows whose keys were never
    written are not lost; rows that have no key at all end the job. Counts of runs come to the driver, one for each part.
    """
    found = {b.name: b for b in CM.manifests(spark, path) or []}
    compared = [p for p in parts if any(q != p and found[p].may_share(found[q]) for q in parts)]
    if not compared:
        return [], [], None
    names = F.array(*[F.lit(p) for p in compared])
    rows = CM.read_batches(spark, path, _stored_schema(), compared)
    rows = rows.select(_demanded("content_sha").alias("content_sha"), F.array_position(names, F.col("batch_id")).cast("int").alias("place"))
    first = packed(rows).groupBy("_sha", "content_sha").agg(F.min("place").alias("place"))
    kept = {compared[r.place - 1]: r.n for r in first.groupBy("place").agg(F.count(F.lit(1)).alias("n")).collect()}
    mixed = [p for p in compared if p in kept and kept[p] != found[p].n_runs]
    chosen = first.select("_sha", "content_sha", F.get(names, F.col("place") - 1).alias("batch_id"))
    return mixed, [p for p in compared if p not in kept], chosen.where(F.col("batch_id").isin(*mixed)) if mixed else None


def write_rejects(rejects: DataFrame, path: str, batch_id: str | None = None) -> None:
    rejects.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{path}/batch_id={batch_id or new_batch()}")
