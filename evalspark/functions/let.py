"""Bind a value once inside an expression.

A Column that is used several times in an expression is repeated in it, and nested repeats multiply: the plan grows,
generated code passes the method size limit, and the value is computed again for every use.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), lambda bound: body(bound)), F.lit(0))


def computed_once(df: DataFrame) -> DataFrame:
    """``df`` with its columns computed before anything that follows.

    The optimizer moves a filter below the projection that computes its column, by putting the column's expression
    into the filter: an expensive expression then runs for the filter and again for the result. A filter on generated
    columns stays above the generator, and this is the generator that gives each row back as it is.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))
