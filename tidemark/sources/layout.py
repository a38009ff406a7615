"""Tables in buckets of a key and partitions of a month, so that joins don't shuffle and months are pruned."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.expectations import Expectation
from tidemark.sources.tables import STORED, observed, settle

MONTH = "ano_mes"
MONTH_NOTE = "Year and month of purchase as one number, such as 201703; filter by it to read only those months."


@dataclass(frozen=True)
class Layout:
    """Rows are dealt to buckets by ``key`` and sorted by it; ``month`` is the time whose month divides them."""

    key: str
    month: str | None = None


def with_month(df: DataFrame, layout: Layout) -> DataFrame:
    if layout.month is None or MONTH in df.columns:
        return df
    number = (F.year(layout.month) * 100 + F.month(layout.month)).cast("int")
    return df.withColumn(MONTH, number).withMetadata(MONTH, {"comment": MONTH_NOTE})


def write_laid_out(
    df: DataFrame,
    name: str,
    path: str,
    layout: Layout,
    buckets: int,
    expectations: Sequence[Expectation] = (),
    dealt: bool = False,
) -> int:
    """Write to a fresh path as the table ``name`` and return the row count.

    The rows are shuffled by the key here, once, and never again by what reads them. ``dealt`` says that
    the frame's tasks hold whole buckets already, as joins and groups of such tables do.
    """
    rows = with_month(df, layout)
    if not dealt:
        rows = rows.repartition(buckets, layout.key)
    rows, seen = observed(rows, expectations)
    writer = rows.write.mode("errorifexists").options(**STORED).option("path", path)
    writer = writer.bucketBy(buckets, layout.key).sortBy(layout.key)
    if layout.month:
        writer = writer.partitionBy(MONTH)
    writer.saveAsTable(name)
    return settle(seen, path)["_rows"]


NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


def partition_of(month: int | None) -> str:
    """A month's folder, such as ``ano_mes=201703``."""
    return f"{MONTH}={NO_MONTH if month is None else month}"


def months_of(spark: SparkSession, name: str) -> list[str]:
    """The folders of a table's months."""
    return [r[0].replace("=null", f"={NO_MONTH}") for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]


def partition_path(path: str, partition: str) -> str:
    return f"{path.rstrip('/')}/{partition}"


def attach_statements(
    df: DataFrame, name: str, path: str, layout: Layout, buckets: int, partitions: dict[str, str] | None = None
) -> list[str]:
    """What makes the table known to a catalog that isn't: its definition, and where each month lies."""
    fields = [f for f in df.schema.fields if f.name != MONTH or not layout.month]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    if layout.month:
        columns += f", `{MONTH}` int"
    parted = f"PARTITIONED BY ({MONTH}) " if layout.month else ""
    made = [
        f"CREATE SCHEMA IF NOT EXISTS {name.split('.')[0]}",
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {parted}"
        f"CLUSTERED BY (`{layout.key}`) SORTED BY (`{layout.key}`) INTO {buckets} BUCKETS LOCATION '{path}'",
    ]
    for partition, place in sorted((partitions or {}).items()):
        made.append(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({partition.replace(NO_MONTH, 'null')}) LOCATION '{place}'")
    return made
