"""Mixing sources to target weights by Pfair scheduling.

A source with weight w must have had w * t blocks, give or take less than one, after every t slots. Its j-th block is
therefore released at floor((j - 1) / w) and due at ceil(j / w), and in every slot the released block with the earliest
deadline runs. Weights are whole numbers of a common denominator, so releases and deadlines are exact however many
blocks there are: no error grows with the number of slots. The blocks that exist are laid out one after another in one
task, which holds a few numbers for each source and writes a row for each block. There are never more than about
``MOST_BLOCKS`` blocks and one for each source: a larger table has larger blocks.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.llm.order import numbered, stored

PERIOD = 10_000
BLOCK_ROWS = 8
#: Blocks that one task lays out, one after another: where BLOCK_ROWS rows a block would make more, blocks are larger.
MOST_BLOCKS = 4_000_000
ALPHA = 0.5
#: Up to so many sources their table is sent to all tasks; beyond, it is joined by shuffle.
BROADCAST_SOURCES = 10_000

_LAYOUT = ("__src", "block", "release", "deadline", "slot")
_LAST_SLOT = 1 << 56
_BATCH = 1 << 15


def whole_weights(weights: dict[str, float], blocks: dict[str, int], period: int = PERIOD) -> dict[str, int]:
    """Weights as whole numbers in exact proportion.

    Those of weight zero get the least share: one part of ``period`` each, or of twice their number where that is more,
    and the others share the rest in proportion. Weights so small that the last of a source's blocks would be due after
    2 ** 56 slots count as zero.
    """
    if any(w < 0 for w in weights.values()):
        raise ValueError("weights must not be negative")
    exact = {s: Fraction(w) for s, w in weights.items()}
    while True:
        common = math.lcm(*{w.denominator for w in exact.values()})
        parts = {s: w.numerator * (common // w.denominator) for s, w in exact.items()}
        total, none = sum(parts.values()), sum(w == 0 for w in parts.values())
        if not total:
            return dict.fromkeys(parts, 1)
        of = max(period, 2 * none) if none else 1
        whole = {s: w * (of - none) if w else total for s, w in parts.items()}
        late = [s for s, w in parts.items() if w and blocks[s] * total * of > _LAST_SLOT * whole[s]]
        if not late:
            return whole
        exact.update(dict.fromkeys(late, Fraction(0)))


def layout(whole: dict[str, int], blocks: dict[str, int]) -> Iterator[tuple[str, int, int, int, int]]:
    """(source, n-th block from 0, release, deadline, slot) of every block, by slot: earliest deadline first, then names.

    A slot stays empty when all blocks that are left are released later.
    """
    names = sorted(s for s, n in blocks.items() if n > 0)
    weights, left = [whole[s] for s in names], [blocks[s] for s in names]
    total = sum(whole.values())
    nth, release = [0] * len(names), [0] * len(names)
    ready = [(-(-total // w), i) for i, w in enumerate(weights)]
    heapq.heapify(ready)
    waiting: list[tuple[int, int]] = []
    slot = 0
    while ready or waiting:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            i = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-(-(nth[i] + 1) * total // weights[i]), i))
        deadline, i = heapq.heappop(ready)
        yield names[i], nth[i], release[i], deadline, slot
        slot += 1
        nth[i] += 1
        if nth[i] < left[i]:
            release[i] = nth[i] * total // weights[i]
            heapq.heappush(waiting, (release[i], i))


def block_rows_for(n_rows: int) -> int:
    """Rows of a block: BLOCK_ROWS, or for tables of more rows as many as keep the blocks to MOST_BLOCKS. A source is less
    than a block off its target, so at any size by less than about one row in MOST_BLOCKS of the table."""
    return max(BLOCK_ROWS, -(-n_rows // MOST_BLOCKS))


def source_key(source: str = "source") -> Column:
    """Null is a source of its own, different from every text."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("null"))


def _layouts(sizes: DataFrame, given: dict[str, float] | None, period: int, block_rows: int) -> DataFrame:
    """(__src, block, release, deadline, slot) of every block of the sources in ``sizes`` (__src, __n: rows)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = {s: n for b in batches for s, n in zip(b.column("__src").to_pylist(), b.column("__n").to_pylist(), strict=True)}
        if not rows:
            return
        weights = {s: float(n) ** ALPHA for s, n in rows.items()} if given is None else {s: given.get(s, 0.0) for s in rows}
        blocks = {s: -(-n // block_rows) for s, n in rows.items()}
        held: list[tuple] = []
        for block in layout(whole_weights(weights, blocks, period), blocks):
            held.append(block)
            if len(held) == _BATCH:
                yield batch(held)
                held = []
        if held:
            yield batch(held)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        src, *numbers = zip(*rows, strict=True)
        return pa.record_batch([pa.array(src, pa.string()), *[pa.array(c, pa.int64()) for c in numbers]], names=list(_LAYOUT))

    return sizes.select("__src", "__n").repartition(1).mapInArrow(run, "__src string, " + ", ".join(f"{c} long" for c in _LAYOUT[1:]))


def schedule(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    *,
    keep: tuple[str, ...] = ("doc_id",),
    source: str = "source",
    period: int = PERIOD,
    block_rows: int | None = None,
    max_sources: int | None = None,
) -> DataFrame:
    """One row per record: the columns ``keep`` and ``source``, block, release, deadline, slot and place.

    ``weights`` by source name (None for null); without them a source weighs the square root of its number of rows.
    A source that has no weight, or zero, gets the least share (one slot of ``period``, see ``whole_weights``): nothing
    is dropped. Rows of a source go into blocks of ``block_rows`` in an order given by a hash of the columns ``keep``;
    ``block`` counts from 0. Without ``block_rows`` the number of rows decides, see ``block_rows_for``. ``place`` is the row's place in the mixed sequence: rising, different for all rows, with
    holes where a source has run out; the others then keep their proportions to each other. As long as a source has
    blocks, the number it has had differs from weight * slots by less than one, after any number of slots.

    Repeated rows get places of their own. Null keys are allowed. An empty table gives no rows. Any number of sources
    is laid out; more than ``max_sources``, if that is given, is an error. Only ``keep`` and ``source`` are read.
    """
    given = None if weights is None else {"null" if s is None else "=" + s: w for s, w in weights.items()}
    if given and any(w < 0 for w in given.values()):
        raise ValueError("weights must not be negative")
    rows = docs.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)], F.col(source).alias("__source"))
    rows = rows.withColumn("__src", source_key("__source"))
    hashed = rows.withColumn("__h", F.xxhash64(*[F.col(f"__k{i}") for i in range(len(keep))]))
    ranked = numbered(hashed, "__src", "__h", into="__rank", name="mixing")
    sizes = stored(ranked.groupBy("__src").agg(F.min("__rank").alias("__head"), F.count(F.lit(1)).alias("__n")), "mixing-sources")
    n_sources = sizes.count()
    if max_sources is not None and n_sources > max_sources:
        raise ValueError(f"more than {max_sources} sources; group them first")
    if block_rows is None:
        block_rows = block_rows_for(sizes.agg(F.sum("__n")).first()[0] or 0)
    heads = sizes.select("__src", "__head")
    ranked = ranked.join(F.broadcast(heads) if n_sources <= BROADCAST_SOURCES else heads, "__src")
    nth = F.col("__rank") - F.col("__head")
    blocks = ranked.withColumns({"block": F.floor(nth / block_rows).cast("long"), "__in": nth % block_rows})
    # Stored, so that the join knows its size: a row for each block is too much to be sent to all tasks unseen.
    placed = blocks.join(stored(_layouts(sizes, given, period, block_rows), "mixing-layout"), ["__src", "block"])
    return placed.select(
        *[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)],
        F.col("__source").alias(source),
        "block",
        "release",
        "deadline",
        "slot",
        (F.col("slot") * block_rows + F.col("__in")).alias("place"),
    )
