"""Connected components by contraction: every vertex joins its smallest neighbour, again and again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """a, b -> vertex, component (one of its vertices) for every vertex of a link.

    Vertices are 64-bit numbers. Each round replaces a link's ends by their smallest neighbours and
    drops what has become a loop, so at least one vertex of each remaining link goes; numbers that are
    hashes shrink geometrically. Rounds are stored, so none repeats an earlier one. Partial sums bound
    what a vertex with many links sends.
    """
    both = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        hooks = stored(
            both(edges).groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to")).withColumnRenamed("a", "from"), "hooks"
        )
        if labels is None:
            labels = hooks.select(F.col("from").alias("vertex"), F.col("to").alias("component"))
        else:
            labels = labels.join(hooks, F.col("component") == F.col("from"), "left").select(
                "vertex", F.coalesce("to", "component").alias("component")
            )
        labels = stored(labels, "labels")
        a = edges.join(hooks.select(F.col("from").alias("a"), F.col("to").alias("x")), "a").select("x", "b")
        ends = a.join(hooks.select(F.col("from").alias("b"), F.col("to").alias("y")), "b").filter("x <> y")
        edges = stored(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
    return labels
