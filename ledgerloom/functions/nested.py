"""Access to nested reports (C-14..C-16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_value_map(fields: Column, name: str = "Name", value: str = "Value") -> Column:
    """C-16: one map for all lookups.  A repeated name keeps its first value, and null names
    are dropped; the array is one record's own field list, so it stays row-sized."""
    pairs = F.filter(fields, lambda f: f[name].isNotNull())
    names = F.array_distinct(F.transform(pairs, lambda f: f[name]))
    return F.map_from_arrays(
        names, F.transform(names, lambda n: F.get(F.filter(pairs, lambda f: f[name] == n), F.lit(0))[value])
    )


def name_value(fields: Column, wanted: str, name: str = "Name", value: str = "Value") -> Column:
    """C-16 for a single name."""
    return F.get(F.filter(fields, lambda f: f[name] == wanted), F.lit(0))[value]


def name_like_value(fields: Column, pattern: str, name: str = "Name", value: str = "Value") -> Column:
    """C-16 with a LIKE pattern: first match in array order."""
    return F.get(F.filter(fields, lambda f: f[name].like(pattern)), F.lit(0))[value]


def safe_offset(arr: Column, zero_based: int) -> Column:
    """C-15: 0-based, null outside the array."""
    return F.get(arr, F.lit(zero_based))
