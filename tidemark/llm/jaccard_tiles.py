"""N-gram Jaccard join: which documents share at least 90 % of their word shingles.

A document's set is its distinct runs of three words (fewer words: the whole sequence). Equal sets are
one class; links are looked for between classes.

Tiles. Sizes fall in bands, each reaching to the last size its smallest member can link with, so the
partners of a set lie in its band or the next one: the two make a tile. In a tile linked sets differ in
at most d shingles, d being fixed by the band. Cut by hash value in d + 1 parts, linked sets agree in at
least one part, so a tile is dealt to buckets by (part, content of the part), and only sets of one bucket
are compared. This loses no link.

Comparison. Every set has a bitmap of hashed shingles; a bit set in one and not the other stands for a
member that isn't shared, which bounds the overlap from above. Pairs that pass are decided exactly on the
sorted arrays. Bitmaps have a bit or two for each member, and four times as many in the last round.

Large buckets. A bucket isn't expanded into its pairs: first each set is compared with the smallest
member it meets most often, and components are formed. From then on only members of different components
of a bucket are compared: those outside its largest component with 1, 4 and 16 hash-drawn members of it,
components being formed anew after each round, and at last all that are still apart. That settles every
pair, by a link, a refusal or a common component.

Shingles are told apart by 64-bit hashes. Defined cases: null and wordless texts have empty sets and
link with nothing; null ids take part, and a component's id is its smallest non-null one; equal rows are
one class; more columns are passed through by ``keep_one`` and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, stored, text_key, whole_row
from tidemark.llm.components import components

WORDS = 3
PERCENT = 90
LEAST_BITS, MOST_BITS = 64, 1 << 14
#: Bits for each member in the bitmaps of the last round.
WIDE = 4
#: Of the names of sets; 64 more tell apart those that share one.
NAME_BITS = 64
#: Members of a bucket's largest component that those outside are compared with, by round.
HEADS = (1, 4, 16)

_MIX = tuple(np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD))


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX[3]
    return (x ^ (x >> np.uint64(29))) * _MIX[0] ^ (x >> np.uint64(32))


def shingles(text: str | None, n: int = WORDS) -> np.ndarray:
    """The set as sorted 64-bit hashes. Bytes lower and split by ASCII alone, as the words ask for."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))], np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    mixed = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        mixed = _scrambled(mixed * _MIX[1] + hashed[k : len(words) - n + 1 + k] + _MIX[2])
    return np.unique(mixed)


def needed(a: int, b: int, percent: int = PERCENT) -> int:
    """The least overlap of linked sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


class Bands:
    """Band k holds the sizes from ``starts[k]`` to ``starts[k + 1] - 1``; grows as sizes come."""

    def __init__(self, percent: int = PERCENT):
        self.percent, self.starts = percent, [1]

    def _reach(self, size: int) -> int:
        """The largest size that can link with this one."""
        return size * 100 // self.percent

    def band(self, size: int) -> int:
        while self.starts[-1] <= size:
            self.starts.append(self._reach(self.starts[-1]) + 1)
        return int(np.searchsorted(self.starts, size, "right")) - 1

    def parts(self, band: int) -> int:
        """One more than the members in which linked sets of the band's tile can differ."""
        largest = self.starts[band + 1] - 1
        other = self._reach(largest)
        return largest + other - 2 * needed(largest, other, self.percent) + 1

    def tiles(self, size: int) -> list[tuple[int, int]]:
        """(tile, parts) that a set of this size is dealt to; where nothing may differ there is none."""
        k = self.band(size)
        self.band(self.starts[k + 1])
        tiles = [k]
        if k and size <= self._reach(self.starts[k] - 1):
            tiles.append(k - 1)
        return [(t, p) for t in tiles if (p := self.parts(t)) > 1]


    def width(self, tile: int, per_member: int = 1) -> int:
        """Bits of the tile's bitmaps: ``per_member`` to twice as many for each member."""
        return min(MOST_BITS, max(LEAST_BITS, per_member << (self.starts[tile + 1] - 1).bit_length()))


def signatures(members: np.ndarray, bands: Bands) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """By tile: a number for each (tile, part, content of the part), and the tile's bitmap.

    Parts are ranges of the sorted hashes; a content's number is a sum over its members.
    """
    sums = np.zeros(len(members) + 1, np.uint64)
    np.cumsum(_scrambled(members ^ _MIX[2]), out=sums[1:])
    found = []
    for tile, parts in bands.tiles(len(members)):
        edges = np.arange(1, parts, dtype=np.float64) * (2.0**64 / parts)
        cuts = np.concatenate([[0], np.searchsorted(members, edges.astype(np.uint64)), [len(members)]])
        content = sums[cuts[1:]] - sums[cuts[:-1]] + np.diff(cuts).astype(np.uint64)
        place = np.arange(parts, dtype=np.uint64) + np.uint64(tile << 32)
        names = _scrambled(content + _scrambled(place + _MIX[1]))
        found.append((tile, names.view(np.int64), bitmap(members, bands.width(tile))))
    return found


def bitmap(members: np.ndarray, width: int) -> np.ndarray:
    """``width`` bits of hashed members, 64 in a number."""
    bits = np.zeros(width, np.uint8)
    bits[(members & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def may_link(a: str, b: str, percent: int = PERCENT) -> Column:
    """False if two bitmaps rule out the overlap that is needed; columns ``{a}n``, ``{a}ones``, ..."""
    shared = F.zip_with(f"{a}bits", f"{b}bits", lambda x, y: F.bit_count(x.bitwiseAND(y)))
    both = F.aggregate(shared, F.lit(0), lambda total, x: total + x)
    bound = F.least(*(F.col(f"{s}n") - F.col(f"{s}ones") + both for s in (a, b)))
    return bound * (100 + percent) >= (F.col(f"{a}n") + F.col(f"{b}n")) * percent


SETS = (
    "doc_id string, mark binary, n long, vid long, proof long,"
    " tile0 int, sigs0 array<long>, bits0 array<long>, tile1 int, sigs1 array<long>, bits1 array<long>"
)
_COLUMNS = [part.split()[0] for part in SETS.split(", ")]


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per document; bitmaps and signatures only with the first of equal sets in the task."""
    import xxhash

    bands, seen = Bands(), set()
    for batch in batches:
        for start in range(0, len(batch), 500):
            part = batch.iloc[start : start + 500]
            rows = []
            for doc_id, mark, text in zip(part["doc_id"], part["mark"], part["text"]):
                members = shingles(text if isinstance(text, str) else None)
                if not len(members):
                    rows.append((doc_id, mark, 0, *[None] * 8))
                    continue
                digest = xxhash.xxh3_128_digest(members.tobytes())
                vid = int.from_bytes(digest[: NAME_BITS // 8], "little", signed=True)
                proof = int.from_bytes(digest[8:], "little", signed=True)
                tiles = [] if digest in seen else signatures(members, bands)
                seen.add(digest)
                own, below = [*tiles, *[(None, None, None)] * 2][:2]
                rows.append((doc_id, mark, len(members), vid, proof, *own, *below))
            yield pd.DataFrame(rows, columns=_COLUMNS, dtype=object)


def document_sets(docs: DataFrame) -> DataFrame:
    """doc_id, mark (of the text), n, and the class; stored."""
    # as strings, ids with nulls among them stay whole in pandas
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_key().alias("mark"), "text")
    sets = rows.mapInPandas(_sets, SETS)
    return _told_apart(stored(sets.withColumn("doc_id", F.col("doc_id").cast("long")), "sets"))


def _told_apart(sets: DataFrame) -> DataFrame:
    """Different sets that happen to have one 64-bit name get new ones, made of all 128 bits.

    Among ten thousand million sets a few names are shared, and nothing but their rows is written again.
    """
    doubtful = sets.groupBy("vid").agg(F.min("proof").alias("x"), F.max("proof").alias("y")).filter("x <> y")
    doubtful = stored(doubtful.select("vid"), "shared-names")
    if doubtful.isEmpty():
        return sets
    renamed = sets.join(doubtful, "vid", "left_semi").withColumn("vid", F.xxhash64("vid", "proof"))
    kept = sets.join(doubtful, "vid", "left_anti")
    return _told_apart(kept.unionByName(stored(renamed, "renamed")))


def _by_tile(sets: DataFrame, *columns: str) -> DataFrame:
    """vid, tile and the tile's columns, of every tile that a set is dealt to."""
    sides = [
        sets.filter(f"tile{k} IS NOT NULL").select(
            "vid", "n", F.col(f"tile{k}").alias("tile"), *(F.col(f"{c}{k}").alias(c) for c in columns)
        )
        for k in (0, 1)
    ]
    return sides[0].unionByName(sides[1])


def _wide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The wide bitmaps of sets, by tile."""
    bands = Bands()
    for batch in batches:
        rows = []
        for vid, raw in zip(batch["vid"], batch["members"]):
            members = np.frombuffer(raw, np.uint64)
            for tile, _ in bands.tiles(len(members)):
                bits = bitmap(members, bands.width(tile, WIDE))
                rows.append((vid, tile, bits, int.from_bytes(bits.tobytes(), "little").bit_count()))
        yield pd.DataFrame(rows, columns=["vid", "tile", "bits", "ones"])


def _arrays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        members = [shingles(t if isinstance(t, str) else None).tobytes() for t in batch["text"]]
        yield pd.DataFrame({"vid": batch["vid"], "members": members})


class _Pairs:
    """What it takes to compare the classes that share a bucket."""

    def __init__(self, docs: DataFrame, sets: DataFrame, dealt: DataFrame, percent: int):
        self.percent = percent
        maps = _by_tile(sets, "bits").join(dealt.select("vid", "tile").distinct(), ["vid", "tile"], "left_semi")
        ones = F.aggregate("bits", F.lit(0), lambda total, x: total + F.bit_count(x))
        self.maps = stored(
            maps.groupBy("vid", "tile").agg(F.first("n").alias("n"), F.first("bits").alias("bits")).withColumn("ones", ones),
            "bitmaps",
        )
        wanted = self.maps.select("vid").distinct()
        one = sets.join(wanted, "vid", "left_semi").groupBy("vid").agg(F.min(F.struct("doc_id", "mark")).alias("d"))
        one = one.select("vid", F.col("d.doc_id").alias("id"), F.col("d.mark").alias("m"))
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        texts = rows.join(
            one, rows["doc_id"].eqNullSafe(one["id"]) & (text_key() == one["m"])
        ).select("vid", "text")
        arrays = texts.mapInPandas(_arrays, "vid long, members binary")
        # equal rows give one array several times
        self.arrays = stored(arrays.groupBy("vid").agg(F.first("members").alias("members")), "arrays")

    def named(self, side: str) -> DataFrame:
        return self.maps.select(
            F.col("vid").alias(side), "tile", *(F.col(c).alias(f"{side}_{c}") for c in ("n", "ones", "bits"))
        )

    def passing(self, pairs: DataFrame) -> DataFrame:
        """Those of pairs (a, b, tile) that the bitmaps don't rule out."""
        mapped = pairs.join(self.named("a"), ["a", "tile"]).join(self.named("b"), ["b", "tile"])
        return mapped.filter(may_link("a_", "b_", self.percent)).select("a", "b")

    def widened(self, members: DataFrame) -> DataFrame:
        """Members of buckets with wide bitmaps in place of the narrow ones."""
        named = self.arrays.join(members.select("vid").distinct(), "vid", "left_semi").select("vid", "members")
        wide = stored(named.mapInPandas(_wide, "vid long, tile int, bits array<long>, ones int"), "wide-bitmaps")
        return members.drop("bits", "ones").join(wide, ["vid", "tile"])

    def links(self, pairs: DataFrame) -> DataFrame:
        """The linked ones of pairs (a, b) of classes, decided on the sorted arrays; stored."""
        percent = self.percent

        @F.pandas_udf("boolean")
        def linked(x: pd.Series, y: pd.Series) -> pd.Series:
            out = []
            for p, q in zip(x, y):
                p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                out.append(both >= needed(len(p), len(q), percent))
            return pd.Series(out, dtype=bool)

        def sided(side: str) -> DataFrame:
            return self.arrays.select(F.col("vid").alias(side), F.col("members").alias(f"{side}_members"))

        held = stored(pairs, "passed").join(sided("a"), "a").join(sided("b"), "b")
        return stored(held.filter(linked("a_members", "b_members")).select("a", "b"), "links")


def buckets(sets: DataFrame) -> DataFrame:
    """sig, vid, tile, rank, low for the buckets of two or more classes, stored."""
    dealt = _by_tile(sets, "sigs").select("vid", "tile", F.explode("sigs").alias("sig"))
    group = Window.partitionBy("sig")
    ranked = dealt.select(
        "sig",
        "vid",
        "tile",
        F.dense_rank().over(group.orderBy("vid")).alias("rank"),
        F.min("vid").over(group).alias("low"),
        F.max("vid").over(group).alias("high"),
    )
    shared = ranked.filter("low <> high").groupBy("sig", "vid").agg(
        *(F.first(c).alias(c) for c in ("tile", "rank", "low"))
    )
    return stored(shared, "buckets")


def _open(dealt: DataFrame, labels: DataFrame) -> DataFrame:
    """The buckets that hold more than one component, with each member's component and the bucket's
    largest one; stored."""
    named = dealt.drop("comp", "main").join(labels.withColumnRenamed("vertex", "vid"), "vid", "left")
    named = named.withColumn("comp", F.coalesce("component", "vid")).drop("component")
    sizes = named.groupBy("sig", "comp").agg(F.count(F.lit(1)).alias("k"))
    mixed = sizes.groupBy("sig").agg(
        F.max_by("comp", F.struct("k", "comp")).alias("main"), F.count(F.lit(1)).alias("comps")
    )
    return stored(named.join(mixed.filter("comps > 1").select("sig", "main"), "sig"), "open")


def _sides(members: DataFrame, side: str, *more: str) -> DataFrame:
    """Members of buckets as one side of a comparison."""
    return members.select(
        "sig", *(F.col(c).alias(f"{side}_{c}") for c in ("vid", "n", "ones", "bits", *more))
    )


def class_components(docs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(a, b: links that connect the classes; vertex, component of every linked class)."""
    dealt = buckets(sets)
    pairs = _Pairs(docs, sets, dealt, percent)
    met = dealt.filter("vid <> low").groupBy("vid", "low", "tile").agg(F.count(F.lit(1)).alias("times"))
    centres = met.groupBy("vid").agg(F.max(F.struct("times", "low", "tile")).alias("c"))
    links = pairs.links(pairs.passing(centres.select(F.col("vid").alias("a"), F.col("c.low").alias("b"), "c.tile")))
    labels = components(links)
    left = _open(dealt.join(pairs.maps, ["vid", "tile"]), labels)
    apart = may_link("a_", "b_", percent)
    for heads in (*HEADS, None):
        if left.isEmpty():
            break
        if heads is None:
            left = pairs.widened(left)
            apart = apart & (F.col("a_rank") > F.col("b_rank")) & (F.col("a_comp") != F.col("b_comp"))
            tried = _sides(left, "a", "rank", "comp").join(_sides(left, "b", "rank", "comp"), "sig")
        else:
            drawn = Window.partitionBy("sig").orderBy(F.xxhash64("vid", "sig"), "vid")
            main = left.filter("comp = main").withColumn("k", F.row_number().over(drawn))
            tried = _sides(left.filter("comp <> main"), "a").join(_sides(main.filter(F.col("k") <= heads), "b"), "sig")
        passed = tried.filter(apart).select(F.least("a_vid", "b_vid").alias("a"), F.greatest("a_vid", "b_vid").alias("b"))
        found = pairs.links(passed.distinct())
        if not found.isEmpty():
            links = stored(links.unionByName(found), "links")
            labels = components(links)
            if heads is not None:
                left = _open(left, labels)
    return links, labels


def all_links(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Every linked pair (a, b) of classes: as many rows as there are links, and all pairs of a bucket
    are tried. ``document_sets`` has the classes of the documents."""
    sets = document_sets(docs)
    dealt = buckets(sets)
    pairs = _Pairs(docs, sets, dealt, percent)
    members = dealt.join(pairs.maps, ["vid", "tile"])
    both = _sides(members, "a").join(_sides(members, "b"), "sig").filter(may_link("a_", "b_", percent))
    return pairs.links(both.filter("a_vid < b_vid").select(F.col("a_vid").alias("a"), F.col("b_vid").alias("b")).distinct())


def _grouped(docs: DataFrame) -> DataFrame:
    """doc_id, mark, n, component (a class of it; null for empty sets) of every document."""
    sets = document_sets(docs)
    _, labels = class_components(docs, sets)
    named = sets.select("doc_id", "mark", "n", "vid").join(labels.withColumnRenamed("vertex", "vid"), "vid", "left")
    return stored(named.select("doc_id", "mark", "n", F.coalesce("component", "vid").alias("component")), "grouped")


def component_table(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    grouped = _grouped(docs)
    least = grouped.filter("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("least"))
    return grouped.join(least, "component", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of every component, that of the smallest id; wordless documents stay. Columns unchanged.

    Nulls count as the largest id; of rows with one id the one with the smallest text hash stays.
    """
    grouped = _grouped(docs).filter("component IS NOT NULL")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    chosen = grouped.groupBy("component").agg(F.min(order).alias("o"))
    rows = grouped.groupBy("doc_id", "mark").agg(F.count(F.lit(1)).alias("_jt_rows"))
    rows = rows.select(F.col("doc_id").alias("_jt_id"), F.col("mark").alias("_jt_mark"), "_jt_rows")
    chosen = chosen.select(F.col("o.doc_id").alias("i"), F.col("o.mark").alias("m")).join(
        rows, F.col("i").eqNullSafe(F.col("_jt_id")) & (F.col("m") == F.col("_jt_mark"))
    )
    chosen = stored(chosen.select("_jt_id", "_jt_mark", "_jt_rows"), "chosen")
    # in a struct, the caller's columns are apart from these, whatever their names
    rows = docs.select(whole_row(docs), F.col("doc_id").cast("long").alias("i"), text_key().alias("m"))
    same = F.col("i").eqNullSafe(F.col("_jt_id")) & (F.col("m") == F.col("_jt_mark"))
    empty = docs.filter(~F.coalesce(F.col("text").rlike(WORD), F.lit(False)))
    kept = rows.join(chosen.filter("_jt_rows = 1"), same).select("row.*").unionByName(empty)
    if chosen.filter("_jt_rows > 1").isEmpty():
        return kept
    repeated = rows.join(chosen.filter("_jt_rows > 1"), same)
    return kept.unionByName(repeated.dropDuplicates(["_jt_id", "_jt_mark"]).select("row.*"))
