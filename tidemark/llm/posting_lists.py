"""Approximate nearest neighbours by balanced posting lists.

Vectors are dealt to lists by their nearest centroid. A vector near a border, that is one whose next
centroids are at most ``BORDER`` times as far, is held by up to ``COPIES`` lists. Centroids are searched
by a graph in memory: from entry points, best first, along each centroid's nearest neighbours. A query
reads the nearest lists until they are sure to hold as many other vectors as asked for, and all lists
within a ratio of the distance reached by then; that ratio is fitted, on a bounded sample, to reach
``RECALL`` of the true neighbours in it. Each vector counts for its nearest list only, so copies of it
in other lists don't count again.

Nearness is the largest inner product. One more coordinate, sqrt(longest^2 - length^2), makes all
vectors equally long, so that larger products are smaller distances; queries have 0 there.

Centroids come from balanced k-means over at most ``SAMPLE`` vectors picked by hash: a full centroid
gets dearer. Every vector is indexed. Lists are packed, neighbours together, into parts of about
``PART_ROWS`` rows; a longer list is cut by hash. Queries go to the parts of their lists in groups of
about ``QUERY_ROWS``, a part and a group meet in one task, and each sends its best rows on.

Defined cases: vectors that are null or zero, hold a null or a non-finite number, differ in length from
the most frequent length, or have a null id take no part; equal rows count once; ties go to the smaller
id; with fewer candidates than asked for, all are returned. Tables of up to ``SMALL`` vectors are one
list.
"""

from __future__ import annotations

import heapq
import math
from bisect import insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

NEIGHBOURS = 20
EVERY = 20
SAMPLE = 20_000
FITTED = 400
SMALL = 400
LIST_ROWS = 200
MOST_LISTS = 4_096
COPIES = 3
BORDER = 1.08
RECALL = 0.98
DEGREE = 16
PART_ROWS = 12_000
QUERY_ROWS = 4_000
ROUNDS = 8


def usable(column: str) -> Column:
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(column).isNotNull() & ~bad & F.exists(column, lambda x: x != 0)


@dataclass
class Index:
    centroids: np.ndarray  # augmented, lists in packing order
    graph: np.ndarray  # each centroid's neighbours
    entries: np.ndarray
    longest: float
    ratio: float


def augmented(x: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(longest**2 - (x * x).sum(axis=1), 0.0))
    return np.column_stack([x, rest])


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] - 2 * (x @ centroids.T) + (centroids * centroids).sum(axis=1)
    return np.sqrt(np.maximum(squares, 0.0))


def balanced_centroids(x: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """k-means whose distances grow with how full a centroid was in the round before."""
    rng = np.random.default_rng(seed)
    centroids = x[rng.choice(len(x), k, replace=False)]
    load = np.ones(k)
    for _ in range(ROUNDS):
        nearest = np.concatenate(
            [(_distances(x[a : a + 4096], centroids) * load**0.05).argmin(axis=1) for a in range(0, len(x), 4096)]
        )
        counts = np.bincount(nearest, minlength=k)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, x)
        filled = counts > 0
        centroids[filled] = sums[filled] / counts[filled, None]
        if not filled.all():
            centroids[~filled] = x[rng.choice(len(x), int((~filled).sum()), replace=False)]
        load = (0.5 * load + 0.5 * np.maximum(counts, 0.1) * k / len(x)).clip(0.1, 10)
    return centroids


def _in_packing_order(centroids: np.ndarray) -> np.ndarray:
    """A chain through the centroids that goes on to the nearest one left."""
    left = np.ones(len(centroids), bool)
    order, at = [], 0
    for _ in range(len(centroids)):
        order.append(at)
        left[at] = False
        if left.any():
            rest = np.flatnonzero(left)
            at = rest[_distances(centroids[at : at + 1], centroids[rest])[0].argmin()]
    return centroids[order]


def search_graph(index: Index, query: np.ndarray, ratio: float, held: list[int], enough: int) -> list[int]:
    """Lists within ``ratio`` of the distance at which the nearest ones hold ``enough`` vectors, nearest first.

    Best first: a centroid beyond that isn't followed. Without enough vectors anywhere, all lists.
    """
    far = lambda ids: _distances(query[None], index.centroids[ids])[0]
    seen = set(index.entries.tolist())
    heap = list(zip(far(index.entries).tolist(), index.entries.tolist()))
    heapq.heapify(heap)
    base, have = math.inf, 0
    found: list[tuple[float, int]] = []
    while heap:
        distance, at = heapq.heappop(heap)
        if distance > ratio * base and len(found) >= DEGREE:
            break
        insort(found, (distance, at))
        have += held[at]
        if have >= enough and distance < base:
            base = _reached(found, held, enough)
        fresh = [v for v in index.graph[at].tolist() if v not in seen]
        if fresh:
            seen.update(fresh)
            for d, v in zip(far(np.array(fresh)).tolist(), fresh):
                heapq.heappush(heap, (d, v))
    # a ratio without bound times no distance is not a number, and bounds nothing
    return [at for distance, at in found if not distance > ratio * base]


def _reached(found: list[tuple[float, int]], held: list[int], enough: int) -> float:
    """Distance up to which the lists hold enough vectors."""
    have = 0
    for distance, at in found:
        have += held[at]
        if have >= enough:
            return distance
    return math.inf


def holders(distances: np.ndarray) -> np.ndarray:
    """The lists that hold a vector, nearest first; -1 where there are fewer than ``COPIES``."""
    few = min(COPIES, distances.shape[1])
    order = np.argsort(distances, axis=1, kind="stable")[:, :few]
    away = np.take_along_axis(distances, order, axis=1)
    return np.where(away <= BORDER * away[:, :1] + 1e-12, order, -1)


def build(sample: np.ndarray, rows: int, longest: float) -> Index:
    """Centroids, their graph, and the ratio that reaches the recall on the sample."""
    x = augmented(sample, longest)
    k = 1 if rows <= SMALL else max(2, min(MOST_LISTS, rows // LIST_ROWS, len(x) // 4))
    centroids = _in_packing_order(balanced_centroids(x, k)) if k > 1 else x.mean(axis=0, keepdims=True)
    between = _distances(centroids, centroids)
    graph = np.argsort(between, axis=1, kind="stable")[:, 1 : DEGREE + 1]
    # a few far links keep the graph in one piece
    far = (np.arange(k)[:, None] + np.array([1, k // 2 + 1, k // 3 + 1])) % k
    graph = np.column_stack([graph, far]) if k > 1 else np.zeros((1, 1), int)
    entries = np.unique(np.linspace(0, k - 1, min(k, 16)).astype(int))
    index = Index(centroids, graph, entries, longest, math.inf)
    if k == 1:
        return index
    queries = sample[: min(FITTED, len(sample))]
    products = queries @ sample.T
    products[np.arange(len(queries)), np.arange(len(queries))] = -np.inf
    wanted = np.argsort(-products, axis=1, kind="stable")[:, : min(NEIGHBOURS, len(sample) - 1)]
    held = holders(_distances(x, centroids))
    q = np.column_stack([queries, np.zeros(len(queries))])
    away = _distances(q, centroids)
    nearest_first = np.argsort(away, axis=1, kind="stable")
    holds = np.bincount(held[:, 0], minlength=k) * (rows / len(x))
    last = (np.cumsum(holds[nearest_first], axis=1) <= NEIGHBOURS).sum(axis=1, keepdims=True).clip(max=k - 1)
    away = away / np.take_along_axis(away, np.take_along_axis(nearest_first, last, axis=1), axis=1).clip(1e-9)
    # a neighbour is reached at the smallest ratio of the lists that hold it
    of = held[wanted]
    reach = np.where(of >= 0, np.take_along_axis(away, of.reshape(len(q), -1).clip(0), axis=1).reshape(of.shape), np.inf)
    index.ratio = max(1.0, float(np.quantile(reach.min(axis=2), RECALL))) + 1e-9
    return index


def _vectors(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _parts_of(sizes: dict[int, int]) -> dict[int, tuple[int, int]]:
    """list -> (first part, number of parts): lists in packing order fill parts, long ones get several."""
    parts, part, filled = {}, 0, 0
    for key in sorted(sizes):
        n = sizes[key]
        if n > PART_ROWS:
            part += filled > 0
            several = -(-n // PART_ROWS)
            parts[key] = (part, several)
            part, filled = part + several, 0
            continue
        if filled + n > PART_ROWS:
            part, filled = part + 1, 0
        parts[key] = (part, 1)
        filled += n
    return parts


def nearest(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = NEIGHBOURS, every: int = EVERY
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each vector whose id is a multiple of ``every``."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable("v"))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = stored(rows.filter(F.size("v") == lengths["n"]).dropDuplicates(["vec_id", "v"]), "vectors")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(length).alias("longest")).first()
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id", F.xxhash64("v")).limit(SAMPLE).select("v").toPandas()
    index = build(_vectors(picked["v"]), facts["n"], facts["longest"] * (1 + 1e-12))

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            held = holders(_distances(augmented(_vectors(batch["v"]), index.longest), index.centroids))
            at, copy = np.nonzero(held >= 0)
            yield pd.DataFrame(
                {
                    "vec_id": batch["vec_id"].to_numpy()[at],
                    "v": batch["v"].to_numpy()[at],
                    "list": held[at, copy],
                    "nearest": copy == 0,
                }
            )

    posted = stored(rows.mapInPandas(post, "vec_id long, v array<double>, list int, nearest boolean"), "postings")
    counts = posted.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.count_if("nearest").alias("own")).collect()
    parts = _parts_of({r["list"]: r["n"] for r in counts})
    held_by = [0] * len(index.centroids)
    for r in counts:
        held_by[r["list"]] = r["own"]
    first = F.lit([parts.get(i, (0, 1))[0] for i in range(len(index.centroids))]).cast("array<int>")
    several = F.lit([parts.get(i, (0, 1))[1] for i in range(len(index.centroids))]).cast("array<int>")
    lists = posted.drop("nearest").withColumn(
        "part", F.get(first, F.col("list")) + F.pmod(F.xxhash64("vec_id"), F.get(several, F.col("list"))).cast("int")
    )

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each query with the lists that it reads in each part."""
        for batch in batches:
            out = []
            for vid, v, same in zip(batch["vec_id"], batch["v"], batch["same"]):
                wanted: dict[int, list[int]] = {}
                # rows of the query's own id are no candidates
                query = np.append(np.asarray(v, np.float64), 0.0)
                near = search_graph(index, query, index.ratio, held_by, k + same)
                for key in near:
                    if key in parts:
                        start, n = parts[key]
                        for part in range(start, start + n):
                            wanted.setdefault(part, []).append(key)
                out += [(vid, v, part, keys, parts.get(near[0], (0, 1))[0]) for part, keys in wanted.items()]
            yield pd.DataFrame(out, columns=["query_id", "q", "part", "lists", "home"])

    queries = rows.filter(F.col("vec_id") % every == 0)
    queries = queries.join(queries.groupBy("vec_id").agg(F.count(F.lit(1)).alias("same")), "vec_id")
    asked = stored(
        queries.mapInPandas(probe, "query_id long, q array<double>, part int, lists array<int>, home int"), "probes"
    )
    # queries that start in one part are a group, cut by hash if it is large
    homes = asked.groupBy("home").agg(F.count_distinct("query_id").alias("n"))
    cuts = homes.select("home", F.greatest(F.lit(1), F.ceil(F.col("n") / QUERY_ROWS)).cast("int").alias("cuts"))
    asked = asked.join(cuts, "home").withColumn(
        "group", F.concat_ws("-", (F.col("home") / 4).cast("int"), F.pmod(F.xxhash64("query_id"), "cuts"))
    )
    meetings = stored(asked.select("part", "group").distinct(), "meetings")

    def meet(key, postings: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(postings) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        postings = postings.sort_values(["list", "vec_id"], kind="stable")
        x, ids, of = _vectors(postings["v"]), postings["vec_id"].to_numpy(), postings["list"].to_numpy()
        q, qids = _vectors(queries["q"]), queries["query_id"].to_numpy()
        begin = {int(v): (int(a), int(b)) for v, a, b in zip(*np.unique(of, return_index=True), np.append(np.unique(of, return_index=True)[1][1:], len(of)))}
        best: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in qids]
        readers: dict[int, list[int]] = {}
        for i, wanted in enumerate(queries["lists"]):
            for v in wanted:
                readers.setdefault(int(v), []).append(i)
        for v, who in readers.items():
            if v not in begin:
                continue
            a, b = begin[v]
            for w in range(0, len(who), 512):
                some = np.array(who[w : w + 512])
                # rounded, so that equal vectors tie whatever the order of addition was
                scores = np.round(q[some] @ x[a:b].T, 12)
                scores[ids[a:b][None, :] == qids[some][:, None]] = -np.inf
                top = np.argsort(-scores, axis=1, kind="stable")[:, :k]
                for i, row, s in zip(some, top, scores):
                    row = row[s[row] > -np.inf]
                    best[i].append((s[row], row + a))
        out_q, out_v, out_s = [], [], []
        for i, found in enumerate(best):
            if not found:
                continue
            scores, rows = (np.concatenate(z) for z in zip(*found))
            order = np.lexsort((ids[rows], -scores))
            kept, have = [], set()
            for j in order:  # a vector of several lists counts once
                name = (int(ids[rows[j]]), x[rows[j]].tobytes())
                if name not in have:
                    have.add(name)
                    kept.append(rows[j])
                    if len(kept) == k:
                        break
            out_q += [qids[i]] * len(kept)
            out_v += ids[kept].tolist()
            out_s += (x[kept] * q[i]).sum(axis=1).tolist()
        return pd.DataFrame({"query_id": out_q, "vec_id": out_v, "score": out_s})

    sent = lists.join(meetings, "part").groupBy("part", "group")
    found = sent.cogroup(asked.drop("cuts", "home").groupBy("part", "group")).applyInPandas(
        meet, "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # equal vectors give equal scores here: each score is summed over one row in one order
    return (
        found.distinct()
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
