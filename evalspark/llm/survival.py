"""Filter interaction audit: what each filter of a set removes in every order, from truth-table survival words.

With five filters there are 32 subsets. A document that fails the filters of mask ``m`` survives the subset ``s`` where
``m & s`` is zero; bit ``s`` of its 32-bit survival word says so. Bit by bit sums of the words of a part and label are the
survivors of every subset, and everything an audit asks for, in whatever order the filters run, is a difference of two of
them. The sums are positional popcounts: three words at a time go through a carry-save adder (their sum bits keep the
weight, their carry bits have twice the weight), so that about as many bitwise operations as there are words count all 32
positions at once, and only a few words of each weight are looked at bit by bit.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.llm.order import stored

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
#: Groups of equal texts with more than this share of all rows are told to every task: at most this many of them exist.
HOT_GROUPS = 1_000

MIN_WORDS = 50
LEAST_DISTINCT = 65
MOST_CAPITALS = 5
SYMBOLS = b"#$%&*|"

_CAPITALS = bytes(range(65, 91))
_CONTINUED = bytes(range(0x80, 0xC0))

#: The survival word of each failure mask.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not m & s) for m in range(SUBSETS)], dtype=np.uint32)


def failures(text: bytes) -> int:
    """Mask of the filters A to D that a text fails; bit 0 is A. Words are runs of bytes that are no ASCII white space."""
    words = text.split()
    points = len(text) - _count(text, _CONTINUED)
    fails = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < LEAST_DISTINCT * len(words),
        100 * _count(text, _CAPITALS) > MOST_CAPITALS * points,
        _count(text, SYMBOLS) > 0,
    )
    return sum(1 << i for i, f in enumerate(fails) if f)


def _count(text: bytes, which: bytes) -> int:
    return len(text) - len(text.translate(None, which))


def positional_popcounts(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit set, by carry-save addition."""
    total, weight, level = np.zeros(32, dtype=np.int64), 1, words
    places = np.arange(32, dtype=np.uint32)
    while len(level):
        carries = []
        while (third := len(level) // 3) > 0:
            a, b, c = level[:third], level[third : 2 * third], level[2 * third : 3 * third]
            odd = a ^ b
            carries.append((a & b) | (odd & c))
            level = np.concatenate((odd ^ c, level[3 * third :]))
        total += weight * ((level[:, None] >> places) & np.uint32(1)).sum(axis=0, dtype=np.int64)
        level, weight = np.concatenate(carries) if carries else level[:0], 2 * weight
    return total


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        masks, digests = [], []
        for t in batch.column("text").cast(pa.large_binary()):
            t = t.as_py() or b""
            masks.append(failures(t))
            digests.append(hashlib.blake2b(t, digest_size=16).digest())
        columns = [batch.column("part"), batch.column("doc_id"), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())]
        yield pa.record_batch(columns, names=["part", "doc_id", "fails", "digest"])


def facts(docs: DataFrame, *, text: str = "text", part: str = "source", key: str = "doc_id") -> DataFrame:
    """(part, doc_id, fails, digest): what the audit needs of each document, from one look at its text."""
    rows = docs.select(F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_facts, "part string, doc_id long, fails int, digest binary")


def _with_copies(rows: DataFrame) -> DataFrame:
    """``rows`` (stored) with the bit of filter E: the text is that of a smaller doc_id anywhere in the table.

    Groups of equal texts are met by digest. Few groups can be large (at most HOT_GROUPS hold more than one part in
    HOT_GROUPS of the rows); those few are sent to all tasks, and their rows are dealt evenly over the join of the rest.
    """
    n = rows.count()
    groups = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL")
    groups = stored(groups, "equal-texts")
    hot = groups.where(F.col("n") * HOT_GROUPS > n).select("digest", F.col("first").alias("hot_first"))
    rest = groups.where(F.col("n") * HOT_GROUPS <= n).select("digest", "first", F.lit(0).cast("long").alias("salt"))
    rows = rows.join(F.broadcast(hot), "digest", "left")  # at most HOT_GROUPS rows
    salt = F.when(F.col("hot_first").isNotNull(), 1 + F.monotonically_increasing_id()).otherwise(0)
    rows = rows.withColumn("salt", salt).join(rest, ["digest", "salt"], "left")
    copied = F.coalesce(F.col("doc_id") > F.coalesce("hot_first", "first"), F.lit(False))
    return rows.select("part", "doc_id", F.col("fails").bitwiseOR(F.when(copied, 16).otherwise(0)).alias("fails"))


def _with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with ``good`` and ``toxic``. Of an id that is labelled several times any label counts; null ids have none."""
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    known = known.where("good OR toxic").withColumn("salt", F.lit(0).cast("long"))
    # Rows without an id would all meet in one task of the join.
    salt = F.when(F.col("doc_id").isNull(), 1 + F.monotonically_increasing_id()).otherwise(0)
    rows = rows.withColumns({"salt": salt, "doc_id": F.coalesce("doc_id", F.lit(0))}).join(known, ["doc_id", "salt"], "left")
    return rows.select("part", "fails", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def _survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows == 0:
            continue
        words = WORDS[batch.column("fails").to_numpy()]
        labels = [np.ones(batch.num_rows, dtype=bool), *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("good", "toxic"))]
        parts = batch.column("part").dictionary_encode()
        codes = parts.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        ends = np.flatnonzero(np.diff(codes[order], append=-1)) + 1
        counts = [np.concatenate([positional_popcounts(words[at][label[at]]) for label in labels]) for at in np.split(order, ends[:-1])]
        names = parts.dictionary.take(pa.array(codes[order][ends - 1]))
        yield pa.record_batch([names, pa.array([c.tolist() for c in counts], pa.list_(pa.int64()))], names=["part", "counts"])


def survivors(masks: DataFrame) -> DataFrame:
    """(part, fails, good, toxic) -> one row per part: arrays ``all``, ``good``, ``toxic`` of the survivors of each subset.

    Every task sums the survival words of its rows; what is shuffled is 96 numbers for each part and Arrow batch.
    """
    summed = masks.mapInArrow(_survivors, "part string, counts array<long>").groupBy("part")
    sums = [F.sum(F.col("counts")[i]).alias(f"c{i}") for i in range(3 * SUBSETS)]
    arrays = [F.array(*[f"c{i}" for i in range(k * SUBSETS, (k + 1) * SUBSETS)]).alias(name) for k, name in enumerate(("all", "good", "toxic"))]
    return summed.agg(*sums).select("part", *arrays)


def _steps() -> str:
    """Every order and step as JSON: the filter and the subsets before and after it."""
    rows = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order, 1):
            rows.append({"filter_order": "".join(FILTERS[i] for i in order), "step": step, "filter": f, "before": before, "after": before | 1 << f})
            before |= 1 << f
    return json.dumps(rows)


def _shapley(f: int) -> Column:
    """Removed by filter ``f``, summed over all orders: each subset precedes it in as many orders as its members and the
    other filters can be arranged."""
    n = len(FILTERS)
    terms = []
    for s in range(SUBSETS):
        if not s & 1 << f:
            size = s.bit_count()
            terms.append(math.factorial(size) * math.factorial(n - 1 - size) * (F.col("all")[s] - F.col("all")[s | 1 << f]))
    return sum(terms[1:], terms[0])


def audit(docs: DataFrame, labels: DataFrame, *, text: str = "text", part: str = "source", key: str = "doc_id") -> DataFrame:
    """One row per part, order of the filters and step: what the step's filter does after those before it.

    Columns: part, filter_order, step, kept, removed, redundant (fail the filter, but are gone already), unique_fails
    (fail it alone), good_lost and toxic_lost (removed, of the labels), shapley. A part is a value of ``part``, null as
    the empty text. Failures: A under 50 words, B under 65 distinct words in 100, C over 5 capitals in 100 code points,
    D any of ``#$%&*|``, E the text of a smaller id of the whole table, whether that is removed or not.

    A null text is an empty one (fails A, and E like others). A row without an id is never E, nor makes another one E;
    rows that repeat an id and text are not copies of each other. No rows give no rows; other columns are ignored.
    """
    rows = stored(facts(docs, text=text, part=part, key=key), "facts")
    by_part = survivors(_with_labels(_with_copies(rows), labels))
    full = SUBSETS - 1
    by_part = by_part.withColumns(
        {
            "shapley": F.array(*[_shapley(f) for f in range(len(FILTERS))]),
            "alone": F.array(*[F.col("all")[full ^ 1 << f] - F.col("all")[full] for f in range(len(FILTERS))]),
            "failing": F.array(*[F.col("all")[0] - F.col("all")[1 << f] for f in range(len(FILTERS))]),
        }
    )
    steps = F.from_json(F.lit(_steps()), "array<struct<filter_order: string, step: int, filter: int, before: int, after: int>>")
    each = by_part.withColumn("s", F.explode(steps))

    def lost(column: str) -> Column:
        return F.get(F.col(column), F.col("s.before")) - F.get(F.col(column), F.col("s.after"))

    return each.select(
        "part",
        "s.filter_order",
        "s.step",
        F.get("all", F.col("s.after")).alias("kept"),
        lost("all").alias("removed"),
        (F.get("failing", F.col("s.filter")) - lost("all")).alias("redundant"),
        F.get("alone", F.col("s.filter")).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.get("shapley", F.col("s.filter")).alias("shapley"),
    )
