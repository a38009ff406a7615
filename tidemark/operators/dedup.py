"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], latest_by: str, tiebreak: Sequence[str]
) -> DataFrame:
    """The row with the greatest ``latest_by`` per key (NULL loses), ties settled by ``tiebreak``.

    ``row_number() = 1`` lets Spark place a group limit below the shuffle, so every task sends at
    most one row per key and a hot key costs the reducer one row per map task.
    """
    order = [F.col(latest_by).desc_nulls_last(), *(F.col(c).desc_nulls_last() for c in tiebreak)]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")
