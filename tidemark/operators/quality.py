"""Data tests. A check is one row ``(teste, valor, esperado, passou)``; a report is many.

A check computes its numbers in one-row frames; scalar subqueries bring them together, and each
number feeds both the printed value and the verdict.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# The texts of the gate.
ALL_PASSED = ("TODOS OS ", " TESTES PASSARAM")
FAILED = "teste(s) falharam: "


class QualityGateError(Exception):
    """At least one data test failed."""


def verdict(name: str, value: Column, expected: Column, passed: Column) -> Column:
    """One report row as a struct; an undecided verdict counts as failed."""
    return F.struct(
        F.lit(name).alias("teste"),
        value.cast("string").alias("valor"),
        expected.cast("string").alias("esperado"),
        F.coalesce(passed, F.lit(False)).alias("passou"),
    )


def same_amount(name: str, a: Column, b: Column, tolerance: str = "0.01") -> Column:
    """Two totals agree within ``tolerance``; a missing total does not."""
    within = F.abs(a - b) <= F.lit(tolerance).cast("decimal(18,2)")
    return verdict(name, F.round(a, 2), F.round(b, 2), within)


def no_rows(name: str, count: Column) -> Column:
    """A count of offending rows is zero."""
    return verdict(name, count, F.lit("0"), count == 0)


def volume(name: str, count: Column, low: int, high: int) -> Column:
    return verdict(name, count, F.lit(f"entre {low} e {high}"), count.between(low, high))


def rows_of(numbers: DataFrame, checks: Sequence[Column]) -> DataFrame:
    """Turn a one-row frame of numbers into report rows."""
    return numbers.select(F.inline(F.array(*checks)))


def beside(numbers: DataFrame, *more: DataFrame) -> DataFrame:
    """Add the single value of each further one-row, one-column frame, as a scalar subquery."""
    return numbers.select("*", *(one.scalar().alias(one.columns[0]) for one in more))


# Stand-alone checks -------------------------------------------------------------------------


def reconcile_sum(
    name: str, a: DataFrame, a_col: str, b: DataFrame, b_col: str, tolerance: str = "0.01"
) -> DataFrame:
    numbers = beside(a.agg(F.sum(a_col).alias("a")), b.agg(F.sum(b_col).alias("b")))
    return rows_of(numbers, [same_amount(name, F.col("a"), F.col("b"), tolerance)])


def orphan_count(
    child: DataFrame,
    child_key: str,
    parent: DataFrame,
    parent_key: str,
    weight: str | None = None,
) -> DataFrame:
    """One row ``n``: child rows without a parent (a NULL key has none).

    If the child's rows stand for several rows each, ``weight`` says for how many.

    The child is counted per key first, so the join moves one row per key and task rather than
    every row, and a hot key is one row.
    """
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    per_key = child.groupBy(F.col(child_key).alias("_key")).agg(rows.alias("_rows"))
    keys = parent.select(F.col(parent_key).alias("_key"))
    lost = per_key.join(keys, "_key", "left_anti")
    return lost.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n"))


def orphans(
    name: str, child: DataFrame, child_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    return rows_of(orphan_count(child, child_key, parent, parent_key), [no_rows(name, F.col("n"))])


def null_count(name: str, df: DataFrame, column: str) -> DataFrame:
    return rows_of(
        df.agg(F.count_if(F.col(column).isNull()).alias("n")), [no_rows(name, F.col("n"))]
    )


def range_check(name: str, df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Values are NULL or within the bounds."""
    outside = F.count_if(~F.col(column).between(low, high))
    return rows_of(df.agg(outside.alias("n")), [no_rows(name, F.col("n"))])


def volume_check(name: str, df: DataFrame, low: int, high: int) -> DataFrame:
    return rows_of(
        df.agg(F.count(F.lit(1)).alias("n")), [volume(name, F.col("n"), low, high)]
    )


def format_check(name: str, df: DataFrame, broken: str) -> DataFrame:
    """No row satisfies the SQL condition ``broken``."""
    return rows_of(df.agg(F.count_if(F.expr(broken)).alias("n")), [no_rows(name, F.col("n"))])


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row ``n``: rows beyond the first of their key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return per_key.agg(F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("n"))


def unique_key(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows_of(duplicate_count(df, keys), [no_rows(name, F.col("n"))])


# Report and gate ----------------------------------------------------------------------------


def quality_report(checks: Sequence[DataFrame]) -> DataFrame:
    """All checks, ordered by name."""
    return reduce(DataFrame.unionByName, checks).orderBy("teste")


def failed_tests(report: DataFrame) -> DataFrame:
    """``(falhas, total)``: how many tests there are, and the failed ones' names in order."""
    failed = F.sort_array(F.collect_list(F.when(~F.col("passou"), F.col("teste"))))
    return report.agg(F.array_join(failed, ", ").alias("falhas"), F.count(F.lit(1)).alias("total"))


def gate_result(report: DataFrame) -> DataFrame:
    """One success row, or an error naming every failed test when it is evaluated."""
    return failed_tests(report).select(
        F.when(
            F.col("falhas") == "",
            F.concat(F.lit(ALL_PASSED[0]), F.col("total"), F.lit(ALL_PASSED[1])),
        )
        .otherwise(F.raise_error(F.concat(F.lit(FAILED), "falhas")))
        .alias("resultado_final")
    )


def quality_gate(report: DataFrame) -> None:
    """Raise when any test of the (already computed) report failed."""
    failed = sorted(row["teste"] for row in report.filter(~F.col("passou")).collect())
    if failed:
        raise QualityGateError(FAILED + ", ".join(failed))
