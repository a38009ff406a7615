"""Text normalisation for addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zip_digits(column: str) -> Column:
    """The digits of a zip prefix, before padding hides how many there were."""
    return F.regexp_replace(F.trim(F.col(column)), "[^0-9]", "")


def zip_prefix(column: str, width: int = 5) -> Column:
    """Digits only, zero-padded on the left (longer input is cut to ``width``)."""
    return F.lpad(zip_digits(column), width, "0")


def place_name(column: str) -> Column:
    return F.initcap(F.trim(F.col(column)))


def state_code(column: str) -> Column:
    return F.upper(F.trim(F.col(column)))
