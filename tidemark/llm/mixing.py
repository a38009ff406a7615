"""Mixing sources to target weights: repeat or thin out documents until shares match.

Sizes are words. A source may grow to ``max_repeats`` times its size at most; what it can't take is
shared among the others by weight. A document is emitted floor(rate) times, plus once more if its
hash-seeded Bernoulli draw falls below the fraction of the rate.

Defined cases: a null text has size 0; a null source is a source of its own, ranked last; a source
without words has target 0 and rate 0, and so its documents are not emitted; equal rows draw alike;
an empty table gives an empty mix. Null ids draw by their text. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, whole_row, word_count

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = "mix-1"
#: Shifts tried for each source's draws; the one whose words come nearest to the target is used.
SHIFTS = 32


def draw(doc_id: str, text: str, seed: str) -> Column:
    """A number in [0, 1) that depends on the document and the seed only: 52 bits of an MD5."""
    name = F.concat_ws(
        ":",
        F.lit(seed),
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")),
        F.coalesce(F.md5(F.col(text)), F.lit("")),
    )
    bits = F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("long")
    return bits / F.lit(float(1 << 52))


def targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """source, source_size -> the same with ``target``, in words.

    Sources in code point order, nulls last, take the weights in turn. Sources are filled up in order
    of size per weight: as the share per weight unit only rises while sources reach their cap, the
    capped ones are a prefix of that order. The windows run over one row per source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighted = sizes.withColumn("rank", rank).withColumn(
        "weight", F.get(F.array(*map(F.lit, weights)), (F.col("rank") - 1) % len(weights)).cast("long")
    )
    cap = F.col("source_size") * max_repeats
    everything = Window.partitionBy().rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    before = Window.orderBy((F.col("source_size") / F.col("weight")), "rank").rowsBetween(
        Window.unboundedPreceding, -1
    )
    filled = weighted.select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        F.sum("weight").over(everything).alias("weights"),
        F.coalesce(F.sum(cap).over(before), F.lit(0)).alias("cap_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"),
    )
    left = F.col("total") - F.col("cap_before")
    capped = left * F.col("weight") > cap * (F.col("weights") - F.col("weight_before"))
    shared = filled.withColumn("capped", capped).select(
        "*",
        (F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), cap)).over(everything), F.lit(0))).alias("pool"),
        F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything).alias("open"),
    )
    by_weight = (F.col("pool") * F.col("weight")).cast("double") / F.col("open").cast("double")
    return shared.select(
        "source",
        "source_size",
        F.when(F.col("capped") | (F.col("source_size") == 0), cap.cast("double"))
        .otherwise(by_weight)
        .alias("target"),
    )


def _copies(shift: Column) -> Column:
    """floor(rate), plus one where the shifted draw falls below the fraction."""
    total, target = F.col("_mix_total"), F.col("_mix_target")
    rate = F.when(total > 0, target / total).otherwise(0.0)
    turned = F.col("_mix_draw") + shift
    turned = turned - F.floor(turned)
    return F.floor(rate) + F.when(turned < rate - F.floor(rate), 1).otherwise(0)


def _join(left: DataFrame, sources: DataFrame) -> DataFrame:
    """Sources may be null; a skewed source is split by AQE if the small side isn't broadcast."""
    right = sources.withColumnRenamed("source", "_mix_source")
    return left.join(right, F.col("source").eqNullSafe(F.col("_mix_source"))).drop("_mix_source")


def plan(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    seed: str = SEED,
    shifts: int = SHIFTS,
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, size and draw of every document; total, target and shift of every source).

    Adding a constant to every draw, modulo 1, leaves each draw uniform. Of ``shifts`` constants each
    source takes the one whose words come nearest to its target, which matters for small sources.
    """
    drawn = stored(
        docs.select(
            "doc_id",
            "source",
            word_count("text").alias("size"),
            draw("doc_id", "text", seed).alias("_mix_draw"),
        ),
        "mix-draws",
    )
    sizes = drawn.groupBy("source").agg(F.sum("size").alias("source_size"))
    aimed = stored(
        targets(sizes, weights, max_repeats).select(
            "source", F.col("source_size").alias("_mix_total"), F.col("target").alias("_mix_target")
        ),
        "mix-targets",
    )
    tries = [F.lit(j / shifts) for j in range(shifts)]
    taken = _join(drawn, aimed).groupBy("source").agg(
        *(F.sum(F.col("size") * _copies(t)).alias(f"taken_{j}") for j, t in enumerate(tries))
    )
    off = [F.abs(F.col(f"taken_{j}") - F.col("_mix_target")) for j in range(shifts)]
    best = F.array_min(F.array(*(F.struct(o.alias("off"), t.alias("shift")) for o, t in zip(off, tries))))
    chosen = _join(taken, aimed).select(
        "source", "_mix_total", "_mix_target", best["shift"].alias("_mix_shift")
    )
    return drawn, stored(chosen, "mix-plan")


def mixture(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes of the document)."""
    drawn, chosen = plan(docs, **options)
    return _join(drawn, chosen).select(
        "doc_id",
        "size",
        F.col("_mix_total").alias("source_size"),
        F.col("_mix_target").alias("target"),
        (F.col("size") * _copies(F.col("_mix_shift"))).cast("long").alias("taken"),
    )


def mix(docs: DataFrame, seed: str = SEED, **options) -> DataFrame:
    """The mixed documents themselves: every row as often as the plan says, columns unchanged."""
    _, chosen = plan(docs, seed=seed, **options)
    # in a struct, the caller's columns are apart from those of the plan, whatever their names
    rows = docs.select(whole_row(docs), "source", draw("doc_id", "text", seed).alias("_mix_draw"))
    copies = _copies(F.col("_mix_shift")).cast("int")
    drawn = _join(rows, chosen).select("row", copies.alias("copies")).filter("copies > 0")
    return drawn.select("row", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).select("row.*")
