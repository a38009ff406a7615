"""Writing tables as Parquet and registering them under their names."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.expectations import Expectation, raise_if_violated, violation_counts
from tidemark.operators.skew import HOT_ROWS, TRACKED, full_slots, hot_within, least_hot

STORED = {"compression": "zstd"}  # written once and kept by every run: small files before quick writes


def observed(
    df: DataFrame, expectations: Sequence[Expectation] = (), more: dict[str, Column] | None = None
) -> tuple[DataFrame, Observation]:
    """The frame with what is to be seen of it while it is written: rows, violations, further aggregates."""
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("_rows"), *violation_counts(expectations)]
    return df.observe(seen, *counts, *(c.alias(n) for n, c in (more or {}).items())), seen


def settle(seen: Observation, path: str, more: Iterable[str] = ()) -> dict:
    """What was seen; an error if a constraint was violated."""
    found = dict(seen.get)
    kept = {name: found.pop(name) for name in ("_rows", *more)}
    raise_if_violated(found, path)
    return kept


def write_table(df: DataFrame, path: str, expectations: Sequence[Expectation] = ()) -> int:
    """Write to a fresh path and return the row count.

    Rows and constraint violations are counted while writing, so neither needs another scan. On a
    violation the files stay for inspection, but the error stops the run before publication.
    """
    return write_watched(df, path, expectations)["_rows"]


def write_watched(
    df: DataFrame,
    path: str,
    expectations: Sequence[Expectation] = (),
    more: dict[str, Column] | None = None,
) -> dict:
    """``write_table`` that also gives further aggregates over the rows written, by their names."""
    rows, seen = observed(df, expectations, more)
    rows.write.mode("errorifexists").options(**STORED).parquet(path)
    return settle(seen, path, more or ())


def write_finding_hot(
    df: DataFrame,
    path: str,
    key: str,
    hot_rows: int = HOT_ROWS,
    tracked: int = TRACKED,
    more: dict[str, Column] | None = None,
) -> tuple[dict, DataFrame | None]:
    """What was seen while writing, and the keys with more than ``hot_rows`` rows (``None``: there are none).

    The key column of what was written is counted by hash slot; keys are counted only in slots with enough rows for
    a hot one, and only if there are any. Both counts add up on the executors. ``tracked`` bounds how many keys are
    hot, see ``least_hot``.
    """
    found = write_watched(df, path, more=more)
    spark = df.sparkSession
    least = least_hot(found["_rows"], hot_rows, tracked)
    if found["_rows"] <= least:
        return found, None
    written = spark.read.schema(df.schema).parquet(path)
    slots = full_slots(written, key, least).collect()  # SLOTS numbers at most
    if not slots:
        return found, None
    place = f"{path.rstrip('/')}_quentes"
    hot = hot_within(written, key, spark.createDataFrame(slots, "_slot int"), least)
    number = write_table(hot.repartition(1), place)  # MOST_CANDIDATES rows at most; they are counted in many tasks
    return found, spark.read.parquet(place) if number else None


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name_over_files(spark: SparkSession, path: str, name: str, comment: str = "") -> str:
    """The statement that makes ``schema.table`` show the files at ``path``.

    The name is a view over the files, so one statement replaces it and readers always find it.
    """
    return _name_over(spark.read.parquet(path), f"parquet.`{path}`", name, comment)


def name_over_table(spark: SparkSession, table: str, name: str, comment: str = "") -> str:
    """The same over a table, whose buckets and partitions its readers profit from."""
    return _name_over(spark.table(table), table, name, comment)


def _name_over(df: DataFrame, source: str, name: str, comment: str) -> str:
    columns = ", ".join(
        f"`{field.name}`" + (f" COMMENT {quoted(note)}" if (note := field.metadata.get("comment")) else "")
        for field in df.schema.fields
    )
    return f"CREATE OR REPLACE VIEW {name} ({columns}) COMMENT {quoted(comment)} AS SELECT * FROM {source}"


def name_over_query(query: str, name: str, comment: str = "") -> str:
    return f"CREATE OR REPLACE VIEW {name} COMMENT {quoted(comment)} AS {query}"


def _file(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file."""
    files, jpath = _file(spark, path)
    out = files.create(jpath, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    files, jpath = _file(spark, path)
    if not files.exists(jpath):
        return None
    return spark.read.text(path, wholetext=True).first()[0]


def folders_in(spark: SparkSession, path: str) -> list[str]:
    files, jpath = _file(spark, path)
    if not files.exists(jpath):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(jpath) if f.isDirectory())


def delete_folder(spark: SparkSession, path: str) -> None:
    files, jpath = _file(spark, path)
    files.delete(jpath, True)
