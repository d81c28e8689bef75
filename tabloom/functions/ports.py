"""Port range flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tabloom.functions.text import underscored

# Inclusive port ranges.
PORT_RANGES = {
    "is_well_known": (0, 1023),
    "is_registered": (1024, 49151),
    "is_dynamic": (49152, 65535),
}


def in_range(c: Column, low: float, high: float) -> Column:
    """1 inside the closed range, 0 outside it or when missing."""
    return F.coalesce(c.between(low, high), F.lit(False)).cast("int")


def range_flags(c: Column, prefix: str, ranges: dict[str, tuple[float, float]]) -> list[Column]:
    return [in_range(c, low, high).alias(f"{prefix}_{name}") for name, (low, high) in ranges.items()]


def port_features(name: str, ranges: dict[str, tuple[float, float]] | None = None) -> list[Column]:
    port = F.col(f"`{name}`").try_cast("double")
    return range_flags(port, underscored(name), ranges or PORT_RANGES)
