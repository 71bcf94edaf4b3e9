"""Consecutive row numbers without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from evalspark.session import new_shared_path

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row in the partition below


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new table in the shared folder and read back: a lineage cut that outlives executors."""
    path = new_shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, *order: str, into: str, name: str = "numbered") -> DataFrame:
    """``df`` with ``into`` (long): 0, 1, 2, ... in the order of the columns ``order``, over all rows.

    The rows are dealt to sorted ranges, stored, and each range gets the number of rows before it. Only the counts of
    the ranges, one row per shuffle partition, meet in one task. Equal rows get different numbers, in any order; a last
    sort column that differs for all rows lets the ranges split them. Rows should be narrow: keys, not texts. Nulls
    come first. No rows give no rows.
    """
    row, part = f"__row_{into}", f"__part_{into}"
    ranged = df.withColumn(f"__tie_{into}", F.monotonically_increasing_id())
    ranged = ranged.orderBy(*[F.col(c).asc_nulls_first() for c in order], f"__tie_{into}").drop(f"__tie_{into}")
    table = stored(ranged.withColumn(row, F.monotonically_increasing_id()), name)
    table = table.withColumn(part, F.shiftright(row, _ROW_BITS))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = table.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    starts = counts.select(part, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    place = F.col("__start") + F.col(row).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # One row per shuffle partition: the setting bounds its size, not the data.
    return table.join(F.broadcast(starts), part).withColumn(into, place).drop(part, row, "__start")


def row_key(*columns: str) -> F.Column:
    """A 128-bit key of the content of ``columns`` as text. Equal rows have equal keys; null differs from empty."""
    parts = []
    for c in columns:
        text = F.col(c).cast(T.StringType())
        parts += [F.coalesce(F.length(text).cast("string"), F.lit("null")), F.lit(":"), F.coalesce(text, F.lit(""))]
    return F.unhex(F.md5(F.concat(*parts)))


#: Keys with more than one in so many of all rows are told to all tasks: there are at most this many.
HOT_KEYS = 1_000


def looked_up(rows: DataFrame, table: DataFrame, key: str, n: str = "n") -> DataFrame:
    """``rows`` left-joined with ``table`` on ``key``; ``table`` has one row per key and in ``n`` how many rows have it.

    The few keys with very many rows are broadcast, and their rows are dealt evenly over the join of the others, so that
    no task gets them all. ``table`` is read several times: store it before.
    """
    total = table.agg(F.sum(n)).first()[0] or 0
    columns = [c for c in table.columns if c not in (key, n)]
    is_hot = F.col(n) * HOT_KEYS > total
    hot = table.where(is_hot).select(key, F.lit(True).alias("__hot"), *[F.col(c).alias(f"__hot_{c}") for c in columns])
    rest = table.where(~is_hot).select(key, F.lit(0).cast("long").alias("__salt"), *columns)
    met = rows.join(F.broadcast(hot), key, "left")  # at most HOT_KEYS rows
    met = met.withColumn("__salt", F.when(F.col("__hot"), 1 + F.monotonically_increasing_id()).otherwise(0))
    met = met.join(rest, [key, "__salt"], "left")
    found = {c: F.when(F.col("__hot"), F.col(f"__hot_{c}")).otherwise(F.col(c)) for c in columns}
    return met.withColumns(found).select(*rows.columns, *columns)
