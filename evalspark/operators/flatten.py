"""Envelopes to flat rows, one per measurement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.functions.maps import empty_string_map, sorted_entries

BASE = ["schema_version", "timestamp", "git_sha", "trigger", "suite", "model"]
OPTIONAL = ["model_revision", "quantization", "seed"]
# A table of more columns than this is no answer to a question; see column_names.
MOST_COLUMNS = 2_000


def flatten(envelopes: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rows with the run's columns and one measurement each; an envelope without results gives none.

    Columns that the envelopes lack (see ``columns`` of the conversion) are left out. Tags stay a map: a key may be new with any run, and a stored column per key would change the schema of
    the dataset. :func:`tags_to_columns` spreads the keys a query wants.
    """
    keep = keep or []
    has = set(envelopes.columns)
    machine = ["os", "chip", "memory_gb"] if "system" in has else []
    base, optional = [c for c in BASE if c in has], [c for c in OPTIONAL if c in has]
    columns = [*keep, *base, *[F.col(f"system.{c}").alias(c) for c in machine], *optional]
    rows = envelopes.select(*columns, F.explode_outer("results").alias("r")).where(F.col("r").isNotNull())
    names = [*keep, *base, *machine, *optional]
    return rows.select(
        *names,
        *[F.col(f"r.{c}").alias(c) for c in ("name", "metric", "value", "unit", "duration_seconds")],
        F.coalesce("r.tags", empty_string_map()).alias("tags"),
    )


def column_names(names: DataFrame) -> list[str]:
    """Distinct values of a one-column table, sorted, to become columns: more than ``MOST_COLUMNS`` are refused."""
    found = names.distinct().limit(MOST_COLUMNS + 1).collect()
    if len(found) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} names to make columns of; state the ones that are wanted")
    return sorted(r[0] for r in found)


def tag_keys(df: DataFrame) -> list[str]:
    """All tag keys in use, sorted. One aggregation whose result is a schema, so it comes to the driver, bounded."""
    return column_names(df.select(F.explode(F.map_keys("tags")).alias("key")))


def tags_to_columns(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``tag_<key>`` columns in place of the map, NULL where a row has no such tag."""
    wanted = tag_keys(df) if keys is None else keys
    rest = [c for c in df.columns if c != "tags"]
    return df.select(*rest, *[F.col("tags")[k].alias(f"tag_{k}") for k in wanted])


def canonical_results(results: Column) -> Column:
    """Results as an array of orderable structs in sorted order, without ``raw``."""
    return F.array_sort(
        F.transform(
            results,
            lambda r: F.struct(
                *[r[c].alias(c) for c in ("name", "metric", "value", "unit", "duration_seconds")],
                sorted_entries(F.coalesce(r["tags"], empty_string_map())).alias("tags"),
            ),
        )
    )
