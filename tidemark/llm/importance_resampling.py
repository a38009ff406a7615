"""Importance resampling: draw the documents that look most like a target, by array-scored weights and a radix sort.

Words and runs of words fall into buckets by their checksum. Counts of all documents and of the target give every
bucket a gain, the rounded log of how much likelier the target is to use it, and a document's weight is the
sum over its features, looked up in one array. Gumbel noise that follows from the document's id turns the
weights into scores whose order is a draw without replacement in proportion to the likelihood ratio.

The order comes from a distributed radix sort, least significant digits first. Rows stand in blocks of
about the square root of their number. A pass counts each block's rows by digit, sums the counts over lower digits
and, within a digit, over earlier blocks, and adds a row's number within its block and digit: that is where
the row goes, so equal digits keep their order. Digits run over the composite of descending score and
ascending id, as many as differ in any row. After the last pass a row's place is its rank. Every pass
is written down, so a lost executor repeats a part of one pass only.

Defined cases: a null text is empty; a document without features weighs 0; a null id draws by the noise of
an empty id and comes first among equal scores; of rows that agree in score and id, which one is ranked first is
settled when the scores are written; an empty table gives an empty one; an empty target makes rarer buckets
gain. All columns of a drawn document pass through under their names.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

BUCKETS = 10_000
LONGEST_RUN = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
DIGIT_BITS = 11
CHUNK_BYTES = 1 << 22
REMEMBERED = 400_000

#: Lower-cases A-Z; all other ASCII but digits and letters divides words.
FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

SCORED = "doc_id long, n_words long, n_features long, weight long, score long, spread long"


class Buckets(dict):
    """word in bytes -> its bucket."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        bucket = self[word] = zlib.crc32(word) % self.buckets
        return bucket

    def of(self, words: list[bytes], longest: int) -> np.ndarray:
        """Buckets of all runs of one to ``longest`` of the words."""
        runs = [np.fromiter(map(self.__getitem__, words), np.int64, len(words))]
        sums = [zlib.crc32(w) for w in words] if longest > 1 else []
        for n in range(2, longest + 1):  # a run's checksum goes on from that of the run one word shorter
            sums = [zlib.crc32(b" " + w, c) for c, w in zip(sums, words[n - 1 :])]
            runs.append(np.array(sums, np.int64) % self.buckets)
        return np.concatenate(runs)


def words_of(text: str | None) -> Iterator[list[bytes]]:
    """The words, a few megabytes of text at a time."""
    raw = (text or "").encode().translate(FOLDED)
    begin = 0
    while begin < len(raw):
        end = raw.find(b" ", begin + CHUNK_BYTES) if begin + CHUNK_BYTES < len(raw) else -1
        end = len(raw) if end < 0 else end
        yield raw[begin:end].split()
        begin = end


def bucket_runs(text: str | None, buckets: Buckets, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the runs that end in them) of consecutive parts of a text."""
    tail: list[bytes] = []
    for words in words_of(text):
        here = buckets.of(tail + words, longest)
        if tail:  # runs within the tail were counted with the part before
            here = np.concatenate([*_ending_after(here, len(tail), len(tail) + len(words), longest)])
        yield len(words), here
        tail = (tail + words)[-(longest - 1) :] if longest > 1 else []


def _ending_after(runs: np.ndarray, tail: int, words: int, longest: int) -> Iterator[np.ndarray]:
    begin = 0
    for n in range(1, longest + 1):
        count = max(0, words - n + 1)
        yield runs[begin + max(0, tail - n + 1) : begin + count]
        begin += count


def _count(buckets: int, longest: int) -> Callable:
    """What a task's texts add to each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for _, here in bucket_runs(text, known, longest):
                    sums += np.bincount(here, minlength=buckets)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(sums[used], pa.int64())], names=["bucket", "n"])

    return run


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    counted = docs.select("text").mapInArrow(_count(buckets, longest), "bucket long, n long")
    sums = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets, np.int64)
    counts[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Rounded log ratio of the smoothed shares of each bucket, in thousandths."""
    all_corpus, all_target = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    ratios = [(t + 1.0) * all_corpus / ((s + 1.0) * all_target) for s, t in zip(corpus.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Standard Gumbel noise in thousandths, the same in every run."""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8]
    return math.floor(-1000 * math.log(-math.log((int(digits, 16) + 0.5) / 4294967296)))


def _score(gain: np.ndarray, longest: int, seed: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Buckets(len(gain))
        seen = 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = []
            for doc_id, text in zip(ids, batch.column(1).to_pylist()):
                n_words = n_features = weight = 0
                for words, here in bucket_runs(text, known, longest):
                    n_words, n_features, weight = n_words + words, n_features + len(here), weight + int(gain[here].sum())
                rows.append((n_words, n_features, weight, weight + noise(doc_id, seed)))
            # where a row first stands, apart from its values: copies are dealt out like any others
            spread = np.arange(seen, seen + len(ids)) * 0x9E3779B1 + TaskContext.get().partitionId() * 0x85EBCA77
            seen += len(ids)
            columns = np.array(rows, np.int64).reshape(len(rows), 4).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns), pa.array(spread & 0x7FFFFFFFFFFFFFFF)],
                names=["doc_id", "n_words", "n_features", "weight", "score", "spread"],
            )

    return run


def _unsigned(key: str, descends: bool, lowest: int, highest: int) -> tuple[Column, int]:
    """The key as an unsigned number in the bits of a long, and how many bits differ."""
    if highest - lowest < 1 << 63:
        offset = F.lit(highest) - F.col(key) if descends else F.col(key) - F.lit(lowest)
        return offset, (highest - lowest).bit_length()
    flipped = F.col(key).bitwiseXOR(F.lit(-(1 << 63)))
    return F.bitwise_not(flipped) if descends else flipped, 64


def _digits(offset: Column, bits: int) -> list[Column]:
    """The digits, least significant first, of even width."""
    passes = -(-bits // DIGIT_BITS)
    width = -(-bits // passes) if passes else 0
    mask = (1 << width) - 1
    return [F.shiftrightunsigned(offset, k * width).bitwiseAND(F.lit(mask)).cast("int") for k in range(passes)]


def radix_places(rows: DataFrame, keys: list[tuple[str, bool]], spread: str) -> DataFrame:
    """The rows with ``_place``: their number, from 0, in the order of the keys.

    ``rows`` is a stored table; ``keys`` are columns of 64-bit numbers without nulls, the most significant first, with
    whether they descend; ``spread`` is a number from 0 that tells nothing about the keys.
    """
    ends = rows.agg(F.count(F.lit(1)).alias("n"), *(f(k).alias(f"{f.__name__}_{k}") for k, _ in keys for f in (F.min, F.max))).first()
    n = ends["n"]
    side = max(1, math.isqrt(max(0, n - 1)) + 1)  # rows of a block, and nearly the number of blocks
    placed = rows.select("*", F.col(spread).alias("_place"), (F.col(spread) % side).alias("_block"))
    digits = [
        digit
        for key, descends in reversed(keys if n else [])
        for digit in _digits(*_unsigned(key, descends, ends[f"min_{key}"], ends[f"max_{key}"]))
    ]
    for digit in digits or [F.lit(0)]:  # rows without a difference are numbered all the same
        placed = _pass(placed, digit, side)
    return placed.drop("_block")


def _pass(placed: DataFrame, digit: Column, side: int) -> DataFrame:
    """One stable counting sort by a digit; a block takes ``side`` consecutive places afterwards."""
    rows = placed.withColumn("_digit", digit)
    counts = stored(rows.groupBy("_block", "_digit").agg(F.count(F.lit(1)).alias("_n")), "radix-counts")
    totals = {r["_digit"]: r["n"] for r in counts.groupBy("_digit").agg(F.sum("_n").alias("n")).collect()}  # a digit's values at most
    base, below = {}, 0
    for value in sorted(totals):
        base[value], below = below, below + totals[value]
    spark = placed.sparkSession
    bases = F.broadcast(spark.createDataFrame(sorted(base.items()), "_digit int, _base long"))  # 2 ** DIGIT_BITS rows at most
    earlier = Window.partitionBy("_digit").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .join(bases, "_digit")
        .select("_block", "_digit", (F.col("_base") + F.col("_before")).alias("_offset"))
    )
    within = Window.partitionBy("_block", "_digit").orderBy("_place")
    place = (F.col("_offset") + F.row_number().over(within) - 1).cast("long")
    moved = rows.join(offsets, ["_block", "_digit"]).withColumn("_place", place).drop("_offset", "_digit")
    return stored(moved.withColumn("_block", F.floor(F.col("_place") / side)), "radix-pass")


def scored(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST_RUN, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every document, and a number that spreads rows."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_score(gain, longest, seed), SCORED)


def importance_table(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    longest: int = LONGEST_RUN,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score, and the rank of every drawn document."""
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    rows = stored(scored(docs, gain, longest, seed), "resampling-scores")
    out = ["doc_id", "n_features", "weight", "score"]
    may = stored(rows.filter(F.col("n_words") >= least_words).select(*out, "spread", *_id_keys()), "resampling-keys")
    drawn = percent * may.count() // 100
    placed = radix_places(may, [("score", True), ("_known", False), ("_id", False)], "spread")
    rank = F.when(F.col("_place") < drawn, F.col("_place") + 1).cast("long")
    rest = rows.filter(F.col("n_words") < least_words).select(*out, F.lit(None).cast("long").alias("rank"))
    return placed.select(*out, rank.alias("rank")).unionByName(rest)


def _id_keys() -> list[Column]:
    """Null ids first, then by id."""
    known = F.col("doc_id").isNotNull().cast("long")
    return [known.alias("_known"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("_id")]


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, **options: int) -> DataFrame:
    """The drawn documents, all columns unchanged.

    The last rank's score and id say for every document whether it is drawn; only rows equal to it
    in both, copies of one id, have to be counted off.
    """
    least_words = options.get("least_words", LEAST_WORDS)
    longest, seed = options.get("longest", LONGEST_RUN), options.get("seed", SEED)
    buckets = options.get("buckets", BUCKETS)
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    rows = stored(scored(docs, gain, longest, seed).filter(F.col("n_words") >= least_words), "resampling-scores")
    may = stored(rows.select("score", "spread", "doc_id", *_id_keys()), "resampling-keys")
    drawn = percent * may.count() // 100
    placed = radix_places(may, [("score", True), ("_known", False), ("_id", False)], "spread")
    last = placed.filter(F.col("_place") == drawn - 1).first() if drawn else None
    if last is None:
        return docs.limit(0)

    @F.pandas_udf("n_words long, score long")
    def judged(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        known, out = Buckets(len(gain)), []
        for doc_id, text in zip(ids, texts):
            doc_id = None if doc_id is None else int(doc_id)
            parts = [(w, int(gain[b].sum())) for w, b in bucket_runs(text, known, longest)]
            out.append((sum(w for w, _ in parts), sum(g for _, g in parts) + noise(doc_id, seed)))
        return pd.DataFrame(out, columns=["n_words", "score"])

    # as strings, ids with nulls among them stay whole in pandas; a struct keeps all columns apart from ours
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    seen = whole.withColumn("at", judged(F.col("row.doc_id").cast("string"), F.col("row.text")))
    seen = seen.filter(F.col("at.n_words") >= least_words)
    known, doc_id = F.col("row.doc_id").isNotNull().cast("long"), F.coalesce(F.col("row.doc_id").cast("long"), F.lit(0))
    here = F.struct((-F.col("at.score")).alias("s"), known.alias("k"), doc_id.alias("i"))
    limit = F.struct(F.lit(-last["score"]).alias("s"), F.lit(last["_known"]).alias("k"), F.lit(last["_id"]).alias("i"))
    same = placed.filter((F.col("score") == last["score"]) & (F.col("_known") == last["_known"]) & (F.col("_id") == last["_id"]))
    open_places = same.filter(F.col("_place") < drawn).count()
    return seen.filter(here < limit).unionByName(seen.filter(here == limit).limit(open_places)).select("row.*")
