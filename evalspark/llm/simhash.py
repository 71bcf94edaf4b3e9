"""SimHash near-duplicates: fingerprints, and the links between them found with pivot distance tables.

Every distinct fingerprint gets its Hamming distances to ``PIVOTS`` reference fingerprints. By the triangle inequality
two fingerprints that differ in r bits have distances to each reference that differ by r at most, so a pair whose
greatest difference of coordinates exceeds r is discarded unseen; what is left is verified bit by bit.

Alone, distances to references cannot spare looking at all pairs of 64-bit fingerprints (a reference keeps 57 % of random
pairs at r = 4), so pairs meet first in buckets: of b blocks of bits at most r are touched by r differing bits, hence a
pair agrees on b - r of them, and each choice of that many blocks is one key. More blocks make longer keys, and so
smaller buckets, but more of them for each fingerprint: their number follows the number of distinct fingerprints.
Tables of coordinates are compared within buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.llm.components import components
from evalspark.llm.order import looked_up, stored
from evalspark.llm.words import mix

RADIUS = 4
SHINGLE = 4
SEED = 42
PIVOTS = 16
#: Distinct fingerprints that a bucket holds by chance, at most; see blocks_for.
CHANCE = 16
#: Fingerprints that one bucket compares in one go; a larger bucket is split and its parts are compared pair by pair.
BUCKET = 2048

_LITTLE = 16
_EDGE = "a long, b long, hot long"


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits; each is 1 if it is set in more than half of the XXH64 hashes of the word shingles."""
    words = text.lower().split()  # bytes: A-Z only, and the six characters of ASCII white space
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, seed)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = [0, *(ends[: len(words) - shingle] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[s:e], seed) for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]
    counts = np.zeros(2048, dtype=np.int64)
    column = np.arange(8) * 256
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.bincount((part + column).ravel(), minlength=2048)
    set_in = counts.reshape(8, 256) @ np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
    return int(np.packbits((2 * set_in > len(hashes)).ravel(), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and fp (the 64 bits as a long). A null text is an empty one, whose fingerprint is 0."""
    rows = docs.select(*keep, F.col(text).alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("__text").cast(pa.binary())
            prints = np.array([fingerprint(t.as_py() or b"") for t in column], dtype=np.uint64).view(np.int64)
            kept = batch.drop_columns(["__text"])
            yield pa.record_batch([*kept.columns, pa.array(prints, pa.int64())], names=[*kept.schema.names, "fp"])

    return rows.mapInArrow(run, f"{fields}, fp long")


def pivots(n: int = PIVOTS) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def distances(prints: np.ndarray, references: np.ndarray) -> np.ndarray:
    """The table: a row of coordinates for each reference."""
    return np.bitwise_count(prints[None, :] ^ references[:, None]).astype(np.int8)


def blocks_for(n: int, radius: int = RADIUS) -> int:
    """The fewest blocks with which ``n`` random fingerprints put no more than ``CHANCE`` into a bucket: 6 for up to 33
    million, 7 for up to 2 billion, 8 for up to 69 billion."""
    blocks = radius + 2
    while blocks < 64 and n > CHANCE << 64 * (blocks - radius) // blocks:
        blocks += 1
    return blocks


def block_keys(fp: Column, radius: int, blocks: int) -> Column:
    """array<long>: one key for each choice of ``blocks - radius`` blocks of bits, with which choice it is."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:], strict=False)]
    keys = []
    for n, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        keys.append(F.xxhash64(F.lit(n), *[parts[i] for i in chosen]))
    return F.array(*keys)


def _close(fp: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray, radius: int) -> np.ndarray:
    """Which pairs differ in ``radius`` bits at most: discarded by coordinates first, verified then."""
    left = np.arange(len(i))
    for row in table:
        left = left[np.abs(row[i[left]] - row[j[left]]) <= radius]
    return left[np.bitwise_count(fp[i[left]] ^ fp[j[left]]) <= radius]


def _forest(fp: np.ndarray, table: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect what all links connect: each fingerprint is compared once with those not reached yet."""
    open_, out = np.arange(len(fp)), []
    while len(open_):
        queue, open_ = [int(open_[0])], open_[1:]
        while queue and len(open_):
            at = queue.pop()
            near = open_[_close(fp, table, np.full(len(open_), at), open_, radius)]
            out += [(at, int(x)) for x in near]
            queue += near.tolist()
            open_ = np.setdiff1d(open_, near, assume_unique=True)
    return out


def _links(radius: int, n_pivots: int, limit: int | None):
    """Links within the buckets of rows sorted by bucket. Rows of a bucket above ``limit`` are given back as hot."""
    references = pivots(n_pivots)

    def bucketed(key: np.ndarray, fp: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Complete buckets: links of all, and the positions of hot rows."""
        begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.concatenate((begin, [len(key)])))
        prints = fp.view(np.uint64)
        pairs, hot = [], []
        small = np.repeat(size, size) <= _LITTLE
        for shift in range(1, _LITTLE):
            i = np.flatnonzero(small[:-shift] & (key[:-shift] == key[shift:]))
            if not len(i):
                break
            j = i + shift
            where, at = np.unique(np.concatenate((i, j)), return_inverse=True)
            table = distances(prints[where], references)
            ok = _close(prints[where], table, at[: len(i)], at[len(i) :], radius)
            pairs.append(np.stack((fp[i[ok]], fp[j[ok]]), axis=1))
        for a, n in zip(begin[size > _LITTLE].tolist(), size[size > _LITTLE].tolist(), strict=True):
            own = prints[a : a + n]
            if limit is not None and n > limit:
                hot.append(np.arange(a, a + n))
            elif forest := _forest(own, distances(own, references), radius):
                pairs.append(fp[a:][np.array(forest)])
        return pairs, hot

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            pairs, hot = bucketed(key, fp)
            if pairs and len(linked := np.concatenate(pairs)):
                a, b = linked.min(axis=1), linked.max(axis=1)
                yield pa.record_batch([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64())], names=["a", "b", "hot"])
            if hot:
                yield from given_back(key[np.concatenate(hot)], fp[np.concatenate(hot)])

        def given_back(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            yield pa.record_batch([pa.array(fp), pa.array(fp), pa.array(key)], names=["a", "b", "hot"])

        key, fp, over = np.empty(0, np.int64), np.empty(0, np.int64), None
        for batch in batches:
            key = np.concatenate((key, batch.column("bucket").to_numpy(zero_copy_only=False)))
            fp = np.concatenate((fp, batch.column("fp").to_numpy(zero_copy_only=False)))
            if over is not None:  # more rows of a bucket that is too large already
                n = int(np.searchsorted(key != over, True)) if (key != over).any() else len(key)
                if n:
                    yield from given_back(key[:n], fp[:n])
                key, fp = key[n:], fp[n:]
                over = over if not len(key) else None
            if not len(key):
                continue
            cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
            if cut:
                yield from emit(key[:cut], fp[:cut])
                key, fp = key[cut:], fp[cut:]
            if limit is not None and len(key) > limit:
                over = int(key[0])
                yield from given_back(key, fp)
                key, fp = key[:0], fp[:0]
        if len(key):
            yield from emit(key, fp)

    return run


def links(prints: DataFrame, *, radius: int = RADIUS, n_pivots: int = PIVOTS, blocks: int | None = None, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that connect all that differ in ``radius`` bits at most.

    In a bucket of many close fingerprints the links are a spanning forest, not all pairs: nothing that is linked falls
    apart. Buckets above ``bucket`` come back from the first pass and are dealt as pairs of parts, so that none is held
    by one task. Without ``blocks`` their number is that for the number of fingerprints.
    """
    nodes = prints.select("fp").distinct()
    if blocks is None:
        blocks = blocks_for(nodes.count(), radius)
    keyed = nodes.select(F.explode(block_keys(F.col("fp"), radius, blocks)).alias("bucket"), "fp")
    keyed = keyed.repartition("bucket").sortWithinPartitions("bucket")
    first = stored(keyed.mapInArrow(_links(radius, n_pivots, bucket), _EDGE), "links")
    hot = first.filter(F.col("hot").isNotNull()).select(F.col("hot").alias("bucket"), F.col("a").alias("fp"))
    parts = hot.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) * 2 / bucket).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    dealt = hot.join(parts, "bucket").withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).filter(F.col("own") != F.col("other"))
    pair = F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))
    dealt = dealt.select(pair.alias("bucket"), "fp").repartition("bucket").sortWithinPartitions("bucket")
    second = dealt.mapInArrow(_links(radius, n_pivots, None), _EDGE)
    return first.filter(F.col("hot").isNull()).select("a", "b").union(second.select("a", "b"))


def near_duplicates(docs: DataFrame, *, keep: tuple[str, ...] = (), doc_id: str = "doc_id", text: str = "text", shingle_radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, the columns ``keep``, fp, component (a fingerprint that stands for its component),
    and component_id, the least doc_id it is linked to.

    Fingerprints are linked at ``shingle_radius`` or fewer differing bits, and so on from link to link; equal ones are
    one node. Texts without words have fingerprint 0 and are linked like others. Rows that repeat are rows of the
    result each. A null doc_id takes part but is never the least, unless a component has no other. An empty table
    gives no rows. Other columns are ignored. Only keys and fingerprints are stored and shuffled, never texts.
    """
    columns = [doc_id, *[c for c in keep if c != doc_id]]
    renamed = docs.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(columns)], F.col(text).alias("__body"))
    keys = [f"__k{i}" for i in range(len(columns))]
    prints = stored(with_fingerprints(renamed, keys, "__body"), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("__k0").alias("__least"), F.count(F.lit(1)).alias("n")), "distinct-fingerprints")
    roots = components(links(nodes, radius=shingle_radius))
    linked = nodes.join(roots, nodes.fp == roots.node)
    least = linked.groupBy("root").agg(F.min("__least").alias("component_id"))
    known = linked.join(least, "root").select(F.col("node").alias("fp"), "root", "component_id")
    alone = F.col("root").isNull()
    of = nodes.join(known, "fp", "left").select(
        "fp", "n", F.coalesce("root", "fp").alias("component"), F.when(alone, F.col("__least")).otherwise(F.col("component_id")).alias("component_id")
    )
    # A fingerprint that very many documents share, the empty text's say, must not bring them all into one task.
    return looked_up(prints, stored(of, "components"), "fp").select(*[F.col(k).alias(c) for k, c in zip(keys, columns, strict=True)], "fp", "component", "component_id")


def digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
