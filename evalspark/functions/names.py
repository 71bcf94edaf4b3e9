"""Names derived from model identifiers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from evalspark.functions.let import let
from evalspark.schemas import MODEL_PREFIX_RULES


def slugify(model: Column) -> Column:
    """Lower-case name with every character but letters, digits and ``-`` turned into ``-``; ends trimmed."""
    return F.btrim(F.lower(F.regexp_replace(model, "[^a-zA-Z0-9-]", "-")), F.lit("-"))


def short_model(model: Column, rules: list[tuple[str, str]] | None = None) -> Column:
    """Model name without its routing prefix; the rules apply in order, each at the start of the name only."""
    out = model
    for prefix, replacement in MODEL_PREFIX_RULES if rules is None else rules:
        out = F.regexp_replace(out, "^" + re.escape(prefix), replacement)
    return out


# 2 ** 27 + 1: splits a double into two parts of at most 26 bits each.
_SPLIT = 134217729.0


def score_label(value: Column) -> Column:
    """Three decimals, rounded from the number itself; a number exactly half way goes to the even digit.

    The JVM rounds the shortest decimal text of a double instead, which differs at such numbers: 0.0625 is 0.062, and
    1.0005 lies below the half way. A thousand times a part of 26 bits is exact, so is the distance to the half way.
    """

    def nearest(v: Column) -> Column:
        high = v * _SPLIT - (v * _SPLIT - v)
        low = F.floor(v * 1000).cast("double")
        beyond = (high * 1000 - (low + 0.5)) + (v - high) * 1000
        up = (beyond > 0) | ((beyond == 0) & (low % 2 == 1))
        return F.format_string("%.3f", F.when(v < 1e12, (low + up.cast("int")) / 1000).otherwise(v))

    def signed(v: Column) -> Column:
        return F.concat(F.when(v < 0, "-").otherwise(""), let(F.abs(v), nearest))

    return F.when(value.isNotNull(), let(value.cast("double"), signed))
