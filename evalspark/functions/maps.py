"""Map columns without reliance on the session's duplicate-key policy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def empty_string_map() -> Column:
    return F.create_map().cast("map<string,string>")


def overlay(base: Column, top: Column) -> Column:
    """``base`` with the entries of ``top`` added; where both have a key, ``top`` wins."""
    kept = F.map_filter(base, lambda k, _: ~F.map_contains_key(top, k))
    return F.map_concat(kept, top)


def last_wins(entries: Column) -> Column:
    """Map from an array of (key, value) structs; a repeated key keeps its last value."""
    from_end = F.reverse(F.transform(entries, lambda e: e["key"]))
    last = F.filter(
        entries,
        lambda e, i: F.array_position(from_end, e["key"]) == (F.size(entries) - i),
    )
    return F.map_from_entries(last)


def sorted_entries(m: Column) -> Column:
    """Orderable form of a map: entries sorted by key."""
    return F.array_sort(F.map_entries(m))
