"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_ratio(num, den, default=0.0) -> Column:
    """num / den as double, ``default`` when den is 0 or null (ANSI-safe)."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.coalesce(F.try_divide(n.cast("double"), d.cast("double")), F.lit(default).cast("double"))


def round_half_even(c, scale: int = 2) -> Column:
    """Banker's rounding, like numpy.round."""
    return F.bround(F.col(c) if isinstance(c, str) else c, scale)
