"""Row-level constraints: every one a boolean SQL condition."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    name: str
    condition: str
    null_passes: bool = False

    def holds(self) -> Column:
        """True or False, never NULL: a condition that cannot be decided fails by default."""
        return F.coalesce(F.expr(self.condition), F.lit(self.null_passes))


class ExpectationError(Exception):
    """Rows broke a constraint."""


def violation_counts(expectations: Sequence[Expectation]) -> list[Column]:
    """One aggregate per expectation, for ``agg`` or for ``observe`` during a write."""
    return [F.count_if(~e.holds()).alias(e.name) for e in expectations]


def violations(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """``(restricao, violacoes)``, one row per expectation, from a single pass over ``df``."""
    counts = df.agg(*violation_counts(expectations))
    return counts.unpivot([], [e.name for e in expectations], "restricao", "violacoes")


def raise_if_violated(counts: dict[str, int], what: str = "table") -> None:
    broken = {name: n for name, n in sorted(counts.items()) if n}
    if broken:
        listed = ", ".join(f"{name} ({n} rows)" for name, n in broken.items())
        raise ExpectationError(f"{what}: {listed}")


def enforce(df: DataFrame, expectations: Sequence[Expectation], mode: str = "fail") -> DataFrame:
    """``fail`` raises on any violation, ``drop`` removes those rows, ``report`` counts them."""
    if mode == "report":
        return violations(df, expectations)
    if mode == "drop":
        for e in expectations:
            df = df.filter(e.holds())
        return df
    if mode != "fail":
        raise ValueError(f"unknown mode {mode!r}")
    counted = violations(df, expectations).collect()  # one row per expectation
    raise_if_violated({row["restricao"]: row["violacoes"] for row in counted})
    return df


def unparseable(df: DataFrame, column: str, target: str) -> DataFrame:
    """Rows whose ``column`` holds text that does not cast to ``target`` (for a quarantine table)."""
    return df.filter(F.col(column).isNotNull() & F.col(column).try_cast(target).isNull())


def parseable(df: DataFrame, column: str, target: str) -> DataFrame:
    """The complement of ``unparseable``."""
    return df.filter(F.col(column).isNull() | F.col(column).try_cast(target).isNotNull())
