"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
from collections.abc import Callable
from types import ModuleType
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_folder

#: Words are runs of anything but the six ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the cluster's shared folder: the lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_row(df: DataFrame, name: str = "row") -> Column:
    """All columns in one struct: ``select("row.*")`` gives them back, whatever else was added meanwhile."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias(name)


def word_count(text: str) -> Column:
    """Number of words; 0 where the text is null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def text_key(text: str = "text") -> Column:
    """16 bytes that stand for the text; null stands for itself."""
    return F.unhex(F.md5(F.col(text)))


def per_process(name: str, make: Callable[[], Any]) -> Any:
    """One object for a worker process, made when first asked for and kept between its tasks.

    Functions travel by value, so their own modules' variables begin anew with every task.
    """
    kept = sys.modules.setdefault("_tidemark_kept", ModuleType("_tidemark_kept"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)
