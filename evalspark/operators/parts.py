"""Groups cut into ordered parts of bounded size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evalspark.session import written


def _same(keys: list[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def numbered_within(df: DataFrame, keys: list[str], order: list[str], into: str) -> DataFrame:
    """``df`` with ``into``: 0, 1, 2, ... of the rows of each key, in the order of the columns ``order``.

    A window over a key would put all its rows into one task. Here the rows are dealt to sorted ranges of key *and* order, so
    that a key with most of the rows lies in many ranges; ranges are numbered within themselves, after the rows of the
    key in the ranges before. Rows that are equal in all these columns are numbered in any order. The table is
    written, since ranges are drawn by samples and must not be drawn anew.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in [*keys, *order]]).withColumn("_range", F.spark_partition_id())
    ranged = written(ranged, "ranges")
    sizes = ranged.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_range").alias("_of")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*[f"_of_{k}" for k in keys]).orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    inside = Window.partitionBy(*keys, "_range").orderBy(*order)
    placed = ranged.withColumn("_in", F.row_number().over(inside)).join(sizes, _same(keys, "_of_") & (F.col("_range") == F.col("_of")))
    return placed.withColumn(into, F.col("_before") + F.col("_in") - 1).select(*df.columns, into)


def in_parts(df: DataFrame, keys: list[str], order: list[str], most: int, into: str = "part") -> DataFrame:
    """``df`` with ``into``: the number of the part of its key that a row belongs to, from 0, in the order of ``order``.

    A part has at most ``most`` rows, so that it can be gathered in one row. Keys with no more rows than that are whole: where no
    key has more, which one aggregation tells, nothing else is done.
    """
    largest = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if largest <= most:
        return df.withColumn(into, F.lit(0))
    numbered = numbered_within(df, keys, order, "_number")
    return numbered.withColumn(into, F.floor(F.col("_number") / most).cast("int")).drop("_number")
