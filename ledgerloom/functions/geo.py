"""Distances (H-65, Q19)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Spherical law of cosines on degrees; the cosine is clamped so rounding cannot give NaN."""
    a, b = F.radians(lat1), F.radians(lat2)
    cosine = F.sin(a) * F.sin(b) + F.cos(a) * F.cos(b) * F.cos(F.radians(lon2) - F.radians(lon1))
    return F.acos(F.greatest(F.least(cosine, F.lit(1.0)), F.lit(-1.0))) * EARTH_KM


def band(x: Column, edges: Sequence[float], missing: str = "NA") -> Column:
    """C-19: half-open bands with every edge in the upper band, null in its own."""
    out = F.when(x.isNull(), missing)
    low: float | None = None
    for edge in edges:
        out = out.when(x < edge, f"<{edge:g}" if low is None else f"{low:g}-{edge:g}")
        low = edge
    return out.otherwise(f">={low:g}")
