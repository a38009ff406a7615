"""The landing folder: did everything arrive, and how many records are in it?"""

from __future__ import annotations

import re
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import ARRIVAL_LOG
from tidemark.session import side_by_side
from tidemark.sources.csv import WHOLE, UnclosedQuoteError, layout, records


class ArrivalError(Exception):
    """Files are missing or empty."""


def drop_name(path: Column, base: str) -> Column:
    """The drop a file belongs to: the first step of its path below the landing folder."""
    below = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", base).rstrip("/")
    return F.regexp_extract(path, rf"\Q{below}\E/+([^/]+)", 1)


def landed_files(spark: SparkSession, base: str, names: list[str]) -> DataFrame:
    """``(arquivo, bytes)`` per expected drop that is there; file contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(base)
        .select(drop_name(F.col("path"), base).alias("arquivo"), "length")
    )
    return (
        files.filter(F.col("arquivo").isin(names))
        .groupBy("arquivo")
        .agg(F.sum("length").alias("bytes"))
    )


def count_records(spark: SparkSession, base: str, modes: dict[str, str]) -> DataFrame:
    """``(arquivo, linhas)``; a drop that holds only a header has no row here."""
    counts = []
    for mode in sorted(set(modes.values())):
        names = sorted(name for name, m in modes.items() if m == mode)
        found = records(spark, [f"{base}/{name}" for name in names], mode)
        per_drop = found.groupBy(drop_name(F.col("_file_path"), base).alias("arquivo"))
        counts.append(per_drop.agg(F.count(F.lit(1)).alias("linhas")))
    return reduce(DataFrame.unionByName, counts)


def arrival_check(
    spark: SparkSession,
    base: str,
    expected: dict[str, str],
    checked_at: datetime | None = None,
    modes: dict[str, str] | None = None,
) -> DataFrame:
    """One log row per expected drop, or an error naming every missing and every empty one.

    ``expected`` is ``{table: landing name}``; ``modes`` says how to read each drop (see
    ``read_modes``); without it, files are read whole.
    """
    base = base.rstrip("/")
    names = list(expected.values())
    sizes = {r["arquivo"]: r["bytes"] for r in landed_files(spark, base, names).collect()}
    missing = [f"{base}/{name}" for name in names if name not in sizes]
    present = [name for name in names if name in sizes]
    counts = {}
    if present:
        counted = count_records(spark, base, {n: (modes or {}).get(n, WHOLE) for n in present})
        counts = {r["arquivo"]: r["linhas"] for r in counted.collect()}
    empty = [f"{base}/{name}" for name in present if not counts.get(name)]
    if missing or empty:
        problems = [
            f"{what}: {', '.join(paths)}"
            for what, paths in (("missing", missing), ("empty", empty))
            if paths
        ]
        raise ArrivalError("arrival check failed - " + "; ".join(problems))
    when = checked_at or datetime.now(timezone.utc)
    rows = [(table, name, sizes[name], counts[name], when) for table, name in expected.items()]
    return spark.createDataFrame(rows, ARRIVAL_LOG)


def read_modes(spark: SparkSession, base: str, names: list[str]) -> dict[str, str]:
    """How to read each drop that is there, by its content; an unclosed quote is an error."""
    base = base.rstrip("/")
    landed = [r["arquivo"] for r in landed_files(spark, base, names).collect()]  # one row per expected drop

    def mode(name: str) -> str | UnclosedQuoteError:
        try:
            return layout(spark, f"{base}/{name}")
        except UnclosedQuoteError as error:
            return error

    modes = dict(zip(landed, side_by_side(mode, landed), strict=True))
    open_quotes = [str(m) for m in modes.values() if isinstance(m, UnclosedQuoteError)]
    if open_quotes:
        raise ArrivalError("arrival check failed - " + "; ".join(sorted(open_quotes)))
    return modes


def append_arrival_log(arrivals: DataFrame, path: str) -> None:
    """Add this run's rows to the log; the first run creates it."""
    arrivals.coalesce(1).write.mode("append").parquet(path)
