"""The city's bounding box."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Limits in degrees, both ends included.
LAT_MIN, LAT_MAX = 41.0, 43.0
LON_MIN, LON_MAX = -89.0, -87.0


def in_box(lat: str, lon: str) -> Column:
    """True inside, false outside, NULL without coordinates (so a filter drops it)."""
    return F.col(lat).between(LAT_MIN, LAT_MAX) & F.col(lon).between(LON_MIN, LON_MAX)


def is_finite(column: str) -> Column:
    value = F.col(column)
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
