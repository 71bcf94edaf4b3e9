"""Stored measurements back to envelopes: the inverse of flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalspark.functions.maps import empty_string_map, sorted_entries
from evalspark.operators.flatten import BASE, OPTIONAL
from evalspark.operators.parts import in_parts
from evalspark.schemas import ENVELOPE_COLUMNS, ENVELOPE_DDL
from evalspark.sources.store import canonical_payload

# Measurements that one envelope holds; a run with more comes back in several.
MOST_RESULTS = 100_000

_RUN = [c for c in BASE + OPTIONAL if c != "timestamp"]
_ENTRY = ["name", "metric", "value", "unit", "duration_seconds"]


def stated_time(shard_key: Column, git_sha: Column, suite: Column, timestamp: Column) -> Column:
    """The time of a run as its document stated it.

    The stored column is an instant, and many texts are one instant; the name of the shard has the text itself, with ``-`` for
    each ``:`` and without a last ``Z``. Where the name has another form the instant is written out.
    """
    named = F.split_part(F.regexp_replace(shard_key, r"\Adata/run-", ""), F.concat(F.lit("-"), git_sha, F.lit("-"), suite, F.lit("-")), F.lit(1))
    clock = r"\A(\d{4}-\d\d-\d\d[Tt]\d\d)-(\d\d)-(\d\d(?:\.\d+)?)(?:([+-]\d\d)-(\d\d)|(z)?)\z"

    def part(i: int) -> Column:
        return F.regexp_extract(named, clock, i)

    zone = F.when(part(4) != "", F.concat(part(4), F.lit(":"), part(5))).when(part(6) != "", "z").otherwise("Z")
    stated = F.concat(part(1), F.lit(":"), part(2), F.lit(":"), part(3), zone)
    written_out = F.date_format(F.to_utc_timestamp(timestamp, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return F.when(F.regexp_like(named, F.lit(clock)), stated).otherwise(written_out)


def regroup(rows: DataFrame, most: int = MOST_RESULTS) -> DataFrame:
    """One envelope per stored run: all envelope columns, ``content_sha``, ``shard_key``, ``part``, ``n_results``, ``verified``.

    ``rows`` are flat rows of runs that are stored once each (read one batch, or a compacted store). Results are in
    sorted order, the order in which the content key reads them: ``verified`` says that the envelope has the very content that
    was stored under its key. Runs of more than ``most`` measurements come back in parts of at most so many, from 0 on, which
    cannot be verified alone (NULL); no group is larger than that, however many rows a run has. What flat rows do
    not carry (pull request, generation settings, memory, errors, raw values, other fields of the machine) is absent.
    """
    tags = F.coalesce("tags", empty_string_map())
    entry = F.struct(*_ENTRY, sorted_entries(tags).alias("tags"))
    time = stated_time(F.col("shard_key"), F.col("git_sha"), F.col("suite"), F.col("timestamp"))
    narrow = rows.select("content_sha", "shard_key", time.alias("timestamp"), *_RUN, "os", "chip", "memory_gb", entry.alias("_entry"))
    parted = in_parts(narrow, ["content_sha"], ["_entry"], most)
    context = ["shard_key", "timestamp", *_RUN, "os", "chip", "memory_gb"]
    runs = parted.groupBy("content_sha", "part").agg(F.array_sort(F.collect_list("_entry")).alias("_entries"), F.any_value(F.struct(*context)).alias("_c"))
    results = F.transform("_entries", lambda e: F.struct(*[e[c].alias(c) for c in _ENTRY], F.map_from_entries(e["tags"]).alias("tags")))
    runs = runs.select("content_sha", "part", *[f"_c.{c}" for c in context], results.alias("results"))
    runs = runs.withColumn("system", F.struct("os", "chip", "memory_gb"))
    whole = F.sha2(canonical_payload(), 256) == F.col("content_sha")
    may_be_cut = (F.col("part") > 0) | (F.size("results") >= most)
    verified = F.when(whole, True).when(may_be_cut, F.lit(None).cast("boolean")).otherwise(False)
    return _complete(runs.withColumns({"n_results": F.size("results").cast("bigint"), "verified": verified}))


def _complete(runs: DataFrame) -> DataFrame:
    """All envelope columns, with their types; those that are not carried are NULL, errors are none."""
    types = {f.name: f.dataType for f in T.StructType.fromDDL(ENVELOPE_DDL)}
    system = types["system"]
    none = F.lit(None)
    entry = types["results"].elementType
    made = {
        "system": F.struct(*[(F.col(f"system.{f.name}") if f.name in ("os", "chip", "memory_gb") else none.cast(f.dataType)).alias(f.name) for f in system]),
        "results": F.transform("results", lambda r: F.struct(*[(r[f.name] if f.name != "raw" else none.cast(f.dataType)).alias(f.name) for f in entry])),
        "errors": F.array().cast("array<string>"),
    }
    columns = [made.get(c, F.col(c) if c in runs.columns else none.cast(types[c])).alias(c) for c in ENVELOPE_COLUMNS]
    return runs.select("content_sha", "shard_key", "part", "n_results", "verified", *columns)
