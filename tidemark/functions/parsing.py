"""Typing of raw strings: NULL on bad input, except money, which must fail."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def int_or_null(column: str) -> Column:
    return F.col(column).try_cast("int")


def fixed_or_null(column: str) -> Column:
    """A coordinate as a fixed-point number, whose sums are exact."""
    return F.col(column).try_cast("decimal(20,9)")


def timestamp_or_null(column: str) -> Column:
    return F.try_to_timestamp(F.col(column))


def money(column: str) -> Column:
    """Strict cast: under ANSI a malformed amount aborts the load instead of losing revenue."""
    return F.col(column).cast(MONEY)
