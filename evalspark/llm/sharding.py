"""Sharding over fixed virtual slots: records hash to slots for ever, a small versioned map says where a slot lives."""

from __future__ import annotations

import heapq
import json
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalspark.llm.order import numbered, row_key

N_SLOTS = 4096
#: Slots for each shard, at least, so that shards can be dealt nearly equal bytes.
SLOTS_PER_SHARD = 64
MAP_SCHEMA = T.StructType(
    [T.StructField(n, T.IntegerType(), False) for n in ("version", "vslot", "shard")] + [T.StructField("bytes", T.LongType(), False)]
)


def size_of(text: str = "text") -> F.Column:
    """UTF-8 bytes and one more, so that a record without text also has a size."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def slot_of(*columns: str, n_slots: int = N_SLOTS) -> F.Column:
    """The virtual slot of a record: seven hex digits of the MD5 of its columns, modulo the number of slots."""
    return (F.conv(F.substring(F.hex(row_key(*columns)), 1, 7), 16, 10).cast("long") % n_slots).cast("int")


def slots_for(n_shards: int) -> int:
    """``N_SLOTS``, or the power of two that gives each of many shards SLOTS_PER_SHARD slots."""
    return max(N_SLOTS, 1 << (n_shards * SLOTS_PER_SHARD - 1).bit_length())


def slot_bytes(records: DataFrame, slot: F.Column, size: F.Column) -> DataFrame:
    """(vslot, bytes): partial sums leave each task, so a hot slot costs one row per task."""
    return records.groupBy(slot.alias("vslot")).agg(F.sum(size).alias("bytes"))


@dataclass
class SlotMap:
    """Slot-to-shard assignment; bounded by the number of slots whatever the data size. ``sizes`` are bytes by slot."""

    n_slots: int = N_SLOTS
    version: int = 0
    shard: dict[int, int] = field(default_factory=dict)
    sizes: dict[int, int] = field(default_factory=dict)

    def loads(self) -> dict[int, int]:
        out: dict[int, int] = {}
        for slot, shard in self.shard.items():
            out[shard] = out.get(shard, 0) + self.sizes.get(slot, 0)
        return out

    @classmethod
    def fresh(cls, sizes: dict[int, int], n_shards: int, n_slots: int = N_SLOTS) -> SlotMap:
        """Version 1: slots by falling size, each to the shard with the least bytes so far (the lowest number at ties)."""
        if not 1 <= n_shards <= n_slots:
            raise ValueError(f"{n_shards} shards do not share {n_slots} slots")
        heap = [(0, s) for s in range(n_shards)]
        shard = {}
        for slot in sorted(range(n_slots), key=lambda s: (-sizes.get(s, 0), s)):
            load, to = heapq.heappop(heap)
            shard[slot] = to
            heapq.heappush(heap, (load + sizes.get(slot, 0), to))
        return cls(n_slots, 1, shard, dict(sizes))

    def grown(self, n_new: int = 1) -> SlotMap:
        """The next version with more shards: slots move into new shards only, from whichever old shard has most bytes."""
        shard, loads = dict(self.shard), self.loads()
        old = max(loads, default=-1) + 1
        target = sum(self.sizes.values()) / max(1, old + n_new)
        own: dict[int, list[int]] = {}
        for slot in sorted(shard, key=lambda s: (self.sizes.get(s, 0), -s)):
            own.setdefault(shard[slot], []).append(slot)
        for new in range(old, old + n_new):
            load = 0
            while load < target:
                donor = max((s for s in own if own[s]), key=lambda s: (loads[s], -s), default=None)
                if donor is None or loads[donor] <= target:
                    break
                fits = [s for s in own[donor] if load + self.sizes.get(s, 0) <= target]
                if not fits:
                    break
                slot = fits[-1]
                own[donor].remove(slot)
                loads[donor] -= self.sizes.get(slot, 0)
                load += self.sizes.get(slot, 0)
                shard[slot] = new
        return SlotMap(self.n_slots, self.version + 1, shard, self.sizes)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(self.version, slot, self.shard[slot], self.sizes.get(slot, 0)) for slot in sorted(self.shard)]
        return spark.createDataFrame(rows, MAP_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        """Adds this version to the stored maps. A version is never written twice: that is an error of the writer."""
        self.table(spark).drop("version").coalesce(1).write.mode("errorifexists").parquet(f"{path}/version={self.version}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        """A stored version, by default the last."""
        rows = spark.read.schema(MAP_SCHEMA).parquet(path)
        if version is None:
            version = rows.agg(F.max("version")).first()[0]
        found = rows.filter(F.col("version") == version).collect()  # one row per slot
        return cls(len(found), version, {r.vslot: r.shard for r in found}, {r.vslot: r.bytes for r in found})

    @classmethod
    def current(cls, spark: SparkSession, path: str, n_shards: int) -> SlotMap | None:
        """The last stored version with no more than ``n_shards`` shards, or None where no map is stored."""
        try:
            rows = spark.read.schema(MAP_SCHEMA).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        versions = rows.groupBy("version").agg((F.max("shard") + 1).alias("n")).filter(F.col("n") <= n_shards)
        last = versions.agg(F.max("version")).first()[0]
        if last is None:
            raise ValueError(f"the map stored at {path} has more than {n_shards} shards")
        return cls.load(spark, path, last)

    @staticmethod
    def last_version(spark: SparkSession, path: str) -> int:
        return spark.read.schema(MAP_SCHEMA).parquet(path).agg(F.max("version")).first()[0]

    def shard_of(self, slot: F.Column) -> F.Column:
        """The shard of a slot as a column: a lookup in an array of ``n_slots`` numbers."""
        of = [self.shard[s] for s in range(self.n_slots)]
        if self.n_slots <= N_SLOTS:
            return F.get(F.lit(of), slot)
        return F.get(F.from_json(F.lit(json.dumps(of)), "array<int>"), slot)  # one literal, not one for each slot


def place(
    docs: DataFrame, n_shards: int, map_path: str, *, by: tuple[str, ...] = ("doc_id", "text"), text: str = "text", n_slots: int | None = None
) -> DataFrame:
    """``docs`` with vslot, shard and rebalanced_shard (in place of columns of these names), without a shuffle of rows.

    Law ``bytes``: shards get nearly equal bytes, since thousands of slots are dealt by size. Records never change
    their slot; growing to one more shard edits the map (version 2) and moves only what the new shard takes
    (``rebalanced_shard``). Both versions are stored at ``map_path``.

    The slot is a hash of the columns ``by``. With id and text an id that many records share, or null, is spread over
    the slots; with the id alone its records stay together, and so do copies of one record in any case: where these are
    more than a shard's share, their shard is larger than the others by that much.
    """
    spark, n_slots = docs.sparkSession, n_slots or slots_for(n_shards)
    # At most one row per slot reaches the driver.
    slot = slot_of(*by, n_slots=n_slots)
    sizes = {r.vslot: r.bytes for r in slot_bytes(docs, slot, size_of(text)).collect()}
    first = SlotMap.fresh(sizes, n_shards, n_slots)
    first.save(spark, map_path)
    second = first.grown()
    second.save(spark, map_path)
    return docs.withColumns({"vslot": slot, "shard": first.shard_of(slot), "rebalanced_shard": second.shard_of(slot)})


def place_more(docs: DataFrame, n_shards: int, map_path: str, *, by: tuple[str, ...] = ("doc_id", "text"), text: str = "text") -> DataFrame:
    """``docs``, records that come after those of the map at ``map_path``, with vslot and shard; without a map as ``place``.

    Every slot stays where the last version with no more than ``n_shards`` shards has it, so that records of before and
    now are found alike. With more shards than that version the map is edited: the new shards take slots from the fullest.
    The bytes of the new records are added to the slots', and the map is stored as a new version.
    """
    spark = docs.sparkSession
    before = SlotMap.current(spark, map_path, n_shards)
    if before is None:
        return place(docs, n_shards, map_path, by=by, text=text).drop("rebalanced_shard")
    slot = slot_of(*by, n_slots=before.n_slots)
    sizes = dict(before.sizes)
    for r in slot_bytes(docs, slot, size_of(text)).collect():  # at most one row per slot
        sizes[r.vslot] = sizes.get(r.vslot, 0) + r.bytes
    now = SlotMap(before.n_slots, SlotMap.last_version(spark, map_path), dict(before.shard), sizes)
    now = now.grown(n_shards - 1 - max(before.shard.values()))
    now.save(spark, map_path)
    return docs.withColumns({"vslot": slot, "shard": now.shard_of(slot)})


def assign(docs: DataFrame, n_shards: int, map_path: str, *, key: str = "doc_id", text: str = "text", n_slots: int | None = None) -> DataFrame:
    """One row per record: ``key`` (the id), size, text_crc32, vslot, shard, slot (0, 1, ... in each shard), rebalanced_shard.

    Shards as in ``place``. A null text has size 1. Repeated rows share a virtual slot and get places of their own. An
    empty table gives no rows (and a map of empty slots). Other columns are ignored.
    """
    rows = place(docs.select(F.col(key), F.col(text)), n_shards, map_path, by=(key, text), text=text, n_slots=n_slots)
    rows = rows.select(
        F.col(key), size_of(text).alias("size"), F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("text_crc32"), "vslot", "shard", "rebalanced_shard"
    )
    places = numbered(rows, "shard", key, "text_crc32", into="__place", name="shards")
    heads = places.groupBy("shard").agg(F.min("__place").alias("__head"))  # one row per shard
    return places.join(F.broadcast(heads), "shard").withColumn("slot", F.col("__place") - F.col("__head")).drop("__place", "__head")
