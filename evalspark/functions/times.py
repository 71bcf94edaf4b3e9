"""Points in time from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(text: Column) -> Column:
    """A time with its zone as an instant, NULL where it cannot be read. ``t`` and ``z`` may be in lower case.

    One odd time must never end a job that stores many runs, so nothing is raised.
    """
    return F.try_to_timestamp(F.upper(text))
