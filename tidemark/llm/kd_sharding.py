"""Sharding by a k-d tree over metadata: split at weighted medians until leaves are small enough.

A node that must yield k leaves is cut, along the metadata dimension in which it is widest, where
floor(k/2)/k of its bytes lie to the left; for even k that is the weighted median. A dimension's
values become integers of 31 bits, linear between its extremes (text by its first six bytes), and 32
bits of a hash of the row follow, so that equal values can be cut too. The cut is found by
distributed counting: a pass sums bytes in 4,096 buckets of each open node and goes on inside the
bucket that the target falls into, until a bucket holds a single position. The driver holds the tree
only: one entry per leaf.

Defined cases: a null text has no bytes, a null dimension value comes before all others, null ids are
told apart by their texts. Rows that agree in id and text can't be told apart and stay together. An
empty table yields a tree whose single cut values are 0. More columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import stored, whole_row

ROW_BYTES = 16
DIMENSIONS = ("doc_id", "n_chars", "lang", "source")
BUCKET_BITS = 12
KEY_BITS = 63
TOP = (1 << 31) - 1
#: Aimed rows of one numbering group; a group is numbered in one task.
SLOT_GROUP_ROWS = 2_000


@dataclass
class Tree:
    """Per level and node position: dimension and cut (keys from the cut on go right)."""

    bounds: list[tuple[str, float, float]]
    levels: list[tuple[list[int], list[int]]] = field(default_factory=list)
    leaf_of: list[int] = field(default_factory=list)


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def _number(df: DataFrame, name: str) -> Column:
    """The dimension as a double in its own order; null for null and NaN."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.StringType):
        head = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    return F.nanvl(column.cast("double"), F.lit(None).cast("double"))


def _positions(df: DataFrame, bounds: list[tuple[str, float, float]]) -> list[Column]:
    """31-bit positions; 0 is for nulls."""
    result = []
    for name, low, high in bounds:
        share = (_number(df, name) - F.lit(low)) / F.lit(max(high - low, 1e-300))
        inner = F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * (TOP - 1)
        result.append(F.coalesce(F.floor(inner).cast("long") + 1, F.lit(0).cast("long")))
    return result


def _tail(doc_id: str, text: str) -> Column:
    """32 bits that tell rows with equal values apart."""
    mixed = F.xxhash64(F.col(doc_id), F.crc32(F.col(text)), F.octet_length(text))
    return mixed.bitwiseAND(F.lit((1 << 32) - 1))


def _step(df: DataFrame, level: tuple[list[int], list[int]]) -> DataFrame:
    """One level down from ``_kd_node``; the level's cuts are constant arrays."""
    dims, cuts = level
    at = F.col("_kd_node").cast("int")
    key = _key(F.get(F.lit(dims).cast("array<int>"), at))
    right = (key >= F.get(F.lit(cuts).cast("array<bigint>"), at)).cast("long")
    return df.withColumn("_kd_node", F.col("_kd_node") * 2 + right)


def _descend(df: DataFrame, tree: Tree) -> DataFrame:
    """Adds ``_kd_node``, the position in the last level."""
    df = df.withColumn("_kd_node", F.lit(0).cast("long"))
    for level in tree.levels:
        df = _step(df, level)
    return df


def _key(dim: Column) -> Column:
    return F.shiftleft(F.get(F.col("_kd_at"), dim), 32).bitwiseOR(F.col("_kd_tail"))


def fit(
    rows: DataFrame, bounds: list[tuple[str, float, float]], leaves: int
) -> tuple[Tree, DataFrame]:
    """The tree over rows with ``size``, ``_kd_at`` (positions), ``_kd_tail``; the rows in its leaves.

    Every level is stored with the rows' places, so that a pass scans a narrow table.
    """
    tree, counts = Tree(bounds), [leaves]
    dims = range(len(bounds))
    rows = rows.withColumn("_kd_node", F.lit(0).cast("long"))
    ends = [
        f(F.get("_kd_at", F.lit(d))).alias(f"{name}{d}")
        for d in dims
        for name, f in (("lo", F.min), ("hi", F.max))
    ]
    while max(counts) > 1:
        extents = rows.groupBy("_kd_node").agg(F.sum("size").alias("w"), *ends).collect()
        state = {}
        for row in extents:
            if (k := counts[row["_kd_node"]]) > 1:
                wide = max(dims, key=lambda d: row[f"hi{d}"] - row[f"lo{d}"])
                state[row["_kd_node"]] = (wide, 0, row["w"] * (k // 2) // k)
        cuts = _cuts(rows, state)
        places = range(len(counts))
        level = (
            [state[i][0] if i in state else 0 for i in places],
            [cuts.get(i, 0) if counts[i] > 1 else (1 << 63) - 1 for i in places],
        )
        tree.levels.append(level)
        rows = stored(_step(rows, level), "kd-level")
        counts = [part for k in counts for part in ((k // 2, k - k // 2) if k > 1 else (k, 0))]
    shard = 0
    for k in counts:
        tree.leaf_of.append(shard if k else -1)
        shard += k
    return tree, rows


def _cuts(rows: DataFrame, state: dict[int, tuple[int, int, int]]) -> dict[int, int]:
    """node -> the key whose left side comes nearest to the wanted bytes.

    ``state`` has, by node, the dimension, the key's leading bits found so far and the bytes wanted to
    the left within them; at most one entry per leaf.
    """
    cuts: dict[int, int] = {}
    shift = KEY_BITS
    at = F.col("_kd_node").cast("int")
    while state:
        above, shift = shift, max(0, shift - BUCKET_BITS)
        places = range(max(state) + 1)
        dims, heads, wanted = (
            F.get(F.lit([state[i][k] if i in state else none for i in places]).cast("array<bigint>"), at)
            for k, none in ((0, 0), (1, -1), (2, 0))
        )
        key = _key(dims.cast("int"))
        inside = F.shiftright(key, above) if above < KEY_BITS else F.lit(0).cast("long")
        sums = (
            rows.filter(inside == heads)
            .groupBy("_kd_node", F.shiftright(key, shift).alias("bucket"))
            .agg(F.sum("size").alias("w"), F.min(key).alias("first"), F.max(key).alias("last"))
        )
        running = (
            Window.partitionBy("_kd_node")
            .orderBy("bucket")
            .rowsBetween(Window.unboundedPreceding, 0)
        )
        crossing = (
            sums.withColumn("upto", F.sum("w").over(running))
            .filter((F.col("upto") >= wanted) & (F.col("upto") - F.col("w") < F.greatest(wanted, F.lit(1))))
            .collect()
        )
        following = {}
        for row in crossing:
            dim, _, left = state[row["_kd_node"]]
            left -= row["upto"] - row["w"]
            if row["first"] == row["last"]:
                cuts[row["_kd_node"]] = row["last"] + 1 if left * 2 > row["w"] else row["first"]
            else:
                following[row["_kd_node"]] = (dim, row["bucket"], left)
        state = following
    return cuts


def prepare(docs: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS) -> list[tuple[str, float, float]]:
    """Each dimension's extremes over all rows."""
    numbers = [(n, _number(docs, n)) for n in dimensions]
    row = docs.agg(
        *(f(c).alias(f"{k}_{i}") for i, (_, c) in enumerate(numbers) for k, f in (("lo", F.min), ("hi", F.max)))
    ).first()
    return [(n, row[f"lo_{i}"] or 0.0, row[f"hi_{i}"] or 0.0) for i, (n, _) in enumerate(numbers)]


def _compact(docs: DataFrame, bounds, *more: Column) -> DataFrame:
    return docs.select(
        size_of().alias("size"),
        F.array(*_positions(docs, bounds)).alias("_kd_at"),
        _tail("doc_id", "text").alias("_kd_tail"),
        *more,
    )


def _leaf(tree: Tree) -> Column:
    return F.get(F.lit(tree.leaf_of).cast("array<int>"), F.col("_kd_node").cast("int"))


def leaves_for(docs: DataFrame, target_bytes: int) -> int:
    """How many leaves keep each at about ``target_bytes``."""
    total = docs.agg(F.sum(size_of()).alias("w")).first()["w"] or 0
    return max(1, -(-total // target_bytes))


def add_shards(
    docs: DataFrame, shards: int, dimensions: tuple[str, ...] = DIMENSIONS, column: str = "shard"
) -> DataFrame:
    """All rows and columns, with the shard as one more column (replacing one of that name)."""
    bounds = prepare(docs, dimensions)
    tree, _ = fit(stored(_compact(docs, bounds), "kd-rows"), bounds, shards)
    # in a struct, the caller's columns are apart from those of the tree, whatever their names
    rows = docs.select(
        whole_row(docs), F.array(*_positions(docs, bounds)).alias("_kd_at"), _tail("doc_id", "text").alias("_kd_tail")
    )
    placed = _descend(rows, tree).select("row", _leaf(tree).alias("leaf"))
    names = docs.columns if column in docs.columns else [*docs.columns, column]
    return placed.select(*(F.col("leaf").alias(c) if c == column else F.col("row")[c].alias(c) for c in names))


def write_shards(docs: DataFrame, path: str, shards: int, files_per_shard: int = 4, **options) -> None:
    """The shards as folders ``shard=N``, each of a few files."""
    placed = add_shards(docs, shards, **options)
    part = F.pmod(_tail("doc_id", "text"), F.lit(files_per_shard))
    placed.repartition(shards * files_per_shard, "shard", part).write.partitionBy("shard").parquet(path)


def shard_table(docs: DataFrame, shards: int, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 in each shard) of every row.

    Slots are dealt in groups: a hash cuts a shard into parts of about ``SLOT_GROUP_ROWS`` rows, each
    is numbered in its own window, and its slots start behind those of the parts before it.
    """
    bounds = prepare(docs, dimensions)
    rows = stored(
        _compact(docs, bounds, F.col("doc_id"), F.crc32("text").cast("long").alias("text_crc32")), "kd-rows"
    )
    tree, rows = fit(rows, bounds, shards)
    parts = max(1, rows.count() // (shards * SLOT_GROUP_ROWS))
    placed = (
        rows.withColumn("shard", _leaf(tree))
        .withColumn("part", F.pmod(F.xxhash64("_kd_tail"), F.lit(parts)).cast("int"))
        .select("doc_id", "size", "text_crc32", "shard", "part", "_kd_tail")
    )
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    order = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size", "_kd_tail")
    return (
        placed.withColumn("at", F.row_number().over(order).cast("long") - 1)
        .join(starts, ["shard", "part"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("start") + F.col("at")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
