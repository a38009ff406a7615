"""Distinct counts that add up: sets of dense numbers as bitmaps, merged over any groups.

A plain distinct count of a quarter can't be had from those of its months. A set can: every key gets a number
from 0 on without gaps, and a group keeps the set of its keys' numbers in bitmaps of 32,768 bits, one for each range
of numbers that has any. Merging groups is a bitwise or, and the count is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NUMBER, RANGE, BITS = "numero", "faixa", "bits"
PARTS = 256
MOST_TASKS = 200  # up to so many, a shuffle hands rows on as they come, without holding them


def numbered(rows: DataFrame, key: str, near: str | None = None, parts: int = PARTS) -> DataFrame:
    """``(key, numero)`` of every key but NULL, from 0 without gaps.

    Keys of one ``near`` get neighbouring numbers, so that sets which go by it fill few ranges. Keys are
    numbered within parts by hash, and a part's first number is the size of all parts before it: a
    window over one row per part and value of ``near``. The same rows get the same numbers.
    """
    where = F.lit(None).cast("string") if near is None else F.col(near).cast("string")
    known = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(where).alias("_near"))
    known = known.withColumn("_part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
    sizes = known.groupBy("_near", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(F.col("_near").asc_nulls_first(), "_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(
        F.col("_near").alias("_near_of"),
        F.col("_part").alias("_part_of"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"),
    )
    within = known.withColumn("_rank", F.row_number().over(Window.partitionBy("_near", "_part").orderBy(key)))
    met = F.col("_near").eqNullSafe(F.col("_near_of")) & (F.col("_part") == F.col("_part_of"))
    return within.join(firsts, met).select(key, (F.col("_first") + F.col("_rank") - 1).alias(NUMBER))


def set_of(number: str = NUMBER) -> tuple[Column, Column]:
    """Group by the first, aggregate the second: the set of numbers, one row per range."""
    return (
        F.bitmap_bucket_number(F.col(number)).alias(RANGE),
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(number))).alias(BITS),
    )


def distinct_sets(rows: DataFrame, *groups: str, number: str = NUMBER, repeats: bool = True) -> DataFrame:
    """The sets of numbers of every group.

    Numbers are moved, each once per group, and not bitmaps, which are thousands of bytes even for one number: a
    bitmap is made where all numbers of its group and range are. ``repeats=False`` says that a number comes a few
    times per group at most: then numbers are moved as they are, and only once.
    """
    within, bits = set_of(number)
    numbers = rows.filter(F.col(number).isNotNull()).select(*groups, number)
    if repeats:
        numbers = numbers.distinct()
    together = numbers.withColumn(RANGE, within).repartition(*groups, RANGE)
    return together.groupBy(*groups, RANGE).agg(bits)


def merged_sets(sets: DataFrame, *groups: str) -> DataFrame:
    """The sets of coarser groups.

    Bitmaps shrink much in a shuffle, so tasks of a size measured there would have far more to sort than it says:
    the number of tasks is given.
    """
    tasks = min(MOST_TASKS, int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    together = sets.select(*groups, RANGE, BITS).repartition(tasks, *groups, RANGE)
    return together.groupBy(*groups, RANGE).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_counts(sets: DataFrame, *groups: str, name: str = "distintos") -> DataFrame:
    """How many different numbers every group has; without groups, one row for all."""
    sizes = merged_sets(sets, *groups).withColumn("_size", F.bitmap_count(BITS))
    return sizes.groupBy(*groups).agg(F.coalesce(F.sum("_size"), F.lit(0)).alias(name))
