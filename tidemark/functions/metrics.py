"""Rounded ratios used by marts and KPIs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def per_unit(total: Column, units: Column, digits: int = 2) -> Column:
    """``total / units``, NULL when there are no units."""
    return F.round(total / F.nullif(units, F.lit(0)), digits)


def mean_rounded(total: Column, count: Column, digits: int) -> Column:
    """A mean rebuilt from pre-aggregated sum and count."""
    return F.round(total.cast("double") / F.nullif(count, F.lit(0)), digits)
