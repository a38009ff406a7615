"""Raw files to all-string tables, with proof that no record was lost."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.checksum import FIELDS, contents
from tidemark.schemas import raw_schema
from tidemark.sources.csv import WHOLE, read_csv


CONTENT = "tabela string, linhas long, soma string, xor long"


class ReconciliationError(Exception):
    """A table does not hold as many rows as its files did."""


class ContentError(Exception):
    """A table holds as many rows as its files did, but not the same ones."""


def ingest_all_string(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    mode: str = WHOLE,
) -> DataFrame:
    """Every column as text, untouched, plus load time and source file name."""
    rows = read_csv(spark, path, schema, mode)
    return rows.select(
        *(c for c in rows.columns if c != "_file_path"),
        F.current_timestamp().alias("_ingerido_em"),
        F.substring_index("_file_path", "/", -1).alias("_arquivo_origem"),
    )


def reconcile_counts(log: DataFrame, counts: DataFrame) -> DataFrame:
    """Table counts ``(tabela, linhas_bronze)`` against the newest log entry of each table.

    A table without a log entry does not reconcile.
    """
    newest = log.groupBy("tabela").agg(F.max_by("linhas", "conferido_em").alias("linhas_raw"))
    return counts.join(newest, "tabela", "left").select(
        "tabela",
        "linhas_bronze",
        "linhas_raw",
        F.coalesce(F.col("linhas_bronze") == F.col("linhas_raw"), F.lit(False)).alias("bate"),
    )


def require_reconciled(reconciled: DataFrame) -> None:
    """Raise naming every table whose counts differ (at most one row per table is collected)."""
    off = sorted(r["tabela"] for r in reconciled.filter(~F.col("bate")).collect())
    if off:
        raise ReconciliationError("row counts differ between files and bronze: " + ", ".join(off))


def landed_contents(
    spark: SparkSession, base: str, expected: dict[str, str], modes: dict[str, str] | None = None
) -> DataFrame:
    """``CONTENT`` of every expected drop, from its text in the landing folder."""
    found = []
    for table, name in expected.items():
        schema = raw_schema(table)
        rows = read_csv(spark, f"{base.rstrip('/')}/{name}", schema, (modes or {}).get(name, WHOLE))
        found.append(contents(rows, schema.fieldNames()).select(F.lit(table).alias("tabela"), *FIELDS))
    return reduce(DataFrame.unionByName, found)


def reconcile_contents(landed: DataFrame, loaded: DataFrame) -> DataFrame:
    """Two ``CONTENT`` frames: do number and content agree? A table that is only in one of them doesn't."""
    a, b = landed.alias("a"), loaded.alias("b")
    agree = lambda c: F.coalesce(F.col(f"a.{c}") == F.col(f"b.{c}"), F.lit(False))
    return a.join(b, "tabela", "full").select(
        "tabela",
        F.col("a.linhas").alias("linhas_raw"),
        F.col("b.linhas").alias("linhas_bronze"),
        agree("linhas").alias("conta_bate"),
        (agree("linhas") & agree("soma") & agree("xor")).alias("conteudo_bate"),
    )


def require_contents(reconciled: DataFrame) -> None:
    """Raise naming every table whose content differs (at most one row per table is collected)."""
    off = sorted(r["tabela"] for r in reconciled.filter(~F.col("conteudo_bate")).collect())
    if off:
        raise ContentError("content differs between files and bronze: " + ", ".join(off))
