"""Column expressions shared by the cleaning rules and the reports."""

from tidemark.functions.metrics import mean_rounded, per_unit
from tidemark.functions.parsing import fixed_or_null, int_or_null, money, timestamp_or_null
from tidemark.functions.text import place_name, state_code, zip_digits, zip_prefix

__all__ = [
    "fixed_or_null",
    "int_or_null",
    "mean_rounded",
    "money",
    "per_unit",
    "place_name",
    "state_code",
    "timestamp_or_null",
    "zip_digits",
    "zip_prefix",
]
