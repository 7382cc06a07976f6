"""Repair expressions for quarantined records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def abs_value(c: Column | str) -> Column:
    """Absolute value; the type stays LONG (narrowing to INT would fail or wrap)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.abs(c)


def floor_at(c: Column | str, floor: float) -> Column:
    """Below ``floor`` or NULL -> ``floor``; otherwise unchanged. DOUBLE is kept."""
    c = F.col(c) if isinstance(c, str) else c
    f = F.lit(float(floor))
    return F.greatest(F.coalesce(c, f), f)


def apply_repairs(repairs: dict[str, str]) -> dict[str, Column]:
    """Map of column -> repaired expression from a contract's SQL repair texts."""
    return {name: F.expr(sql) for name, sql in repairs.items()}
