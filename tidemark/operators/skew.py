"""Hot keys: found while a table is written, and joined in parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000  # rows one task should take for a single key
TRACKED = 200_000  # keys a heavy-hitter summary keeps
MOST_CANDIDATES = 100_000  # what one summary gives away at most
SLOTS = 1 << 16  # counters that a task keeps when it looks for hot keys


def heavy_hitters(key: str, hot_rows: int = HOT_ROWS, tracked: int = TRACKED) -> Column:
    """Aggregate: ``(item, count)`` of every key that may hold more than ``hot_rows`` rows.

    A summary of at most ``tracked`` keys, merged from one per task, whose counts are never too low. For a
    frame of few tasks: every summary goes to one place, so over many tasks ``full_slots`` is the way.
    """
    k = min(MOST_CANDIDATES, tracked // 2)
    return F.expr(f"filter(approx_top_k(`{key}`, {k}, {tracked}), x -> x.item IS NOT NULL AND x.count > {hot_rows})")


def least_hot(rows: int, hot_rows: int = HOT_ROWS, tracked: int = TRACKED) -> int:
    """A key above this many rows is surely among the ``heavy_hitters`` of a table of ``rows`` rows.

    The summary's error is at most 3.5 rows / map size; it names keys of more than twice that. Beyond
    ``tracked * hot_rows / 6`` rows of the table the limit grows with the table, as do its tasks.
    """
    k = min(MOST_CANDIDATES, tracked // 2)
    return max(hot_rows, -(-6 * rows // tracked), -(-rows // k))


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(key, _rows)`` for every key above ``hot_rows`` rows, counted exactly; map-side sums."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.filter(F.col("_rows") > hot_rows)


def full_slots(df: DataFrame, key: str, least: int, slots: int = SLOTS) -> DataFrame:
    """``_slot`` of every hash slot whose keys hold more than ``least`` rows together, so that of every key that does.

    A task hands on one number per slot, however many keys it met.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(slot_of(key, slots)).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.filter(F.col("_rows") > least).select("_slot")


def slot_of(key: str, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int").alias("_slot")


def hot_within(df: DataFrame, key: str, slots: DataFrame, least: int) -> DataFrame:
    """``hot_keys`` above ``least`` rows, of which only keys in the ``full_slots`` are counted."""
    named = df.select(key, slot_of(key)).join(F.broadcast(slots), "_slot", "left_semi")
    return hot_keys(named, key, least)


def confirmed(df: DataFrame, key: str, candidates: list, least: int) -> DataFrame:
    """``(key, _rows)`` of the candidates above ``least`` rows, counted exactly; nothing else is counted."""
    named = df.sparkSession.createDataFrame([(c,) for c in candidates], df.select(key).schema)
    few = F.broadcast(named)  # MOST_CANDIDATES rows at most
    return hot_keys(df.select(key).join(few, key, "left_semi"), key, least)


def spread_join(
    big: DataFrame,
    other: DataFrame,
    key: str,
    how: str = "inner",
    hot: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join on ``key`` in which each hot key of ``big`` is split over several tasks.

    ``hot`` has the hot keys and their ``_rows``, as ``confirmed`` or ``hot_keys`` count them: at most
    ``MOST_CANDIDATES``. Rows of all other keys join plainly and keep the layout they are stored in;
    without ``hot`` all rows do.

    The part of a hot row follows from its values and its input task, so it is the same after a retry;
    rows of one key are spread even if one task read them all, and exact copies if several did.
    ``other`` repeats only its hot rows, once per part. Every row still meets every partner once. Only
    ``inner`` and ``left`` keep that promise; in a left join NULL keys, which meet nobody, aren't shuffled.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"spread_join supports inner and left, not {how!r}")
    # Size estimates of a narrow scan can make the big side look fit for broadcast; it is not,
    # hence the merge hints.
    if hot is None:
        return big.join(other.hint("merge"), key, how)
    parts = F.ceil(F.col("_rows") / F.lit(hot_rows)).cast("int")
    few = F.broadcast(hot.select(key, parts.alias("_parts")))
    known = big.filter(F.col(key).isNotNull())
    cold = known.join(few, key, "left_anti").join(other.hint("merge"), key, how)
    scatter = F.pmod(F.xxhash64(*big.columns), F.lit(1 << 30)).cast("int") + F.spark_partition_id()
    left = big.withColumn("_scatter", scatter).join(few, key)
    left = left.withColumn("_part", F.pmod("_scatter", "_parts")).drop("_parts", "_scatter")
    right = other.join(few, key).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    joined = cold.unionByName(left.join(right.hint("merge"), [key, "_part"], how).drop("_part"))
    if how == "left":
        joined = joined.unionByName(big.filter(F.col(key).isNull()).join(other.limit(0), key, how))
    return joined
