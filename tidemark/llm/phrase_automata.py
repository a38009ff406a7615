"""Substring deduplication with automata over repeated phrases.

A window is ``WINDOW`` consecutive words of a document. Every word covered by a window that also starts
anywhere else is removed; windows are judged on the input.

1. Each window elects the phrase of ``PHRASE`` words with the smallest hash in it, so equal windows
   elect equal phrases, wherever they stand. Counted over the corpus, phrases elected once are done
   with: about one word in fifteen is counted instead of all windows.
2. Documents meet the recurring phrases that they hold. A shard is a chunk of documents: its phrases
   are compiled into one Aho-Corasick automaton (bounded by the chunk), and the chunk's documents are
   streamed through it to locate every occurrence. Only windows whose elected phrase was located can
   recur.
3. Those windows are confirmed: windows with one content have one elected phrase with the same words
   around it, so they meet in a group named by about 20 of their words. What recurs inside a chunk is
   settled there, and the chunk sends it on once, so a passage that very many documents share doesn't
   pile up in one group.
4. The runs of confirmed windows go back to their documents.

Texts stand for themselves by a 128-bit hash, and words, phrases and windows by 64-bit ones; confirming
compares 128 bits. Equal texts are taken as one text with a count. Defined cases: null and empty texts
have no words and keep nothing, texts under ``WINDOW`` words keep all; equal rows repeat each other; null
ids and other columns have no influence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, text_key

WINDOW = 35
PHRASE = 6
#: Words on one side of the elected phrase that name a window's group.
ASIDE = 15
CHUNK_BYTES = 6 << 20

_ODD = tuple(np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD))

RUNS = "key binary, first int, n int"
ASKED = f"g long, hashes array<long>, weight int, {RUNS}"


def words_of(text: str | bytes | None) -> list[bytes]:
    """Runs of anything but the six ASCII white space characters."""
    if not text:
        return []
    return (text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text).split()


def hashed(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _ODD[2]
    return x ^ (x >> np.uint64(29))


class Rolling:
    """Hashes of runs of words of any one length: a polynomial modulo 2^64 from two cumulative sums."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        base = np.full(n + 1, _ODD[0])
        base[0] = 1
        inverse = np.full(n + 1, np.uint64(pow(int(_ODD[0]), -1, 1 << 64)))
        inverse[0] = 1
        self.up, down = np.cumprod(base), np.cumprod(inverse)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(scrambled(words) * down[:n], out=self.sums[1:])

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        part = (self.sums[starts + length] - self.sums[starts]) * self.up[starts]
        return scrambled(part ^ _ODD[1]) * _ODD[0]


def elected(phrases: np.ndarray) -> np.ndarray:
    """For each window, where its phrase with the smallest hash starts; of equal ones the first."""
    reach = WINDOW - PHRASE + 1
    views = np.lib.stride_tricks.sliding_window_view(phrases, reach)
    return views.argmin(axis=1) + np.arange(len(views))


def _phrase_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(phrase, text, how often: once or more), one row for equal texts of a batch."""
    for batch in batches:
        counts = batch["key"].value_counts()
        keys, marks, weights = [], [], []
        for key, text in zip(*(batch.drop_duplicates("key")[c] for c in ("key", "text"))):
            words = words_of(text)
            if len(words) < WINDOW:
                continue
            phrases = Rolling(hashed(words)).at(np.arange(len(words) - PHRASE + 1), PHRASE)
            found, times = np.unique(phrases[np.unique(elected(phrases))], return_counts=True)
            keys.append(np.repeat(np.array([key], object), len(found)))
            marks.append(found.view(np.int64))
            weights.append(np.minimum(2, times * counts[key]))
        if keys:
            yield pd.DataFrame(
                {"h": np.concatenate(marks), "key": np.concatenate(keys), "weight": np.concatenate(weights)}
            )


def _runs(doc: np.ndarray, start: np.ndarray, group: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end indices of stretches of consecutive windows of one text (and one group)."""
    cut = (np.diff(doc) != 0) | (np.diff(start) != 1)
    if group is not None:
        cut |= np.diff(group) != 0
    begins = np.concatenate([[0], np.flatnonzero(cut) + 1])
    return begins, np.append(begins[1:], len(doc))


def _times(group: np.ndarray, window: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each (group, window) occurs, by row; and whether the row is its first."""
    order = np.lexsort((window, group))
    g, w = group[order], window[order]
    new = np.concatenate([[True], (g[1:] != g[:-1]) | (w[1:] != w[:-1])])
    sums = np.add.reduceat(weight[order], np.flatnonzero(new))
    times, first = np.empty(len(group), np.int64), np.empty(len(group), bool)
    times[order], first[order] = sums[np.cumsum(new) - 1], new
    return times, first


def _locate(chunk: dict[bytes, list]) -> Iterator[pd.DataFrame]:
    """Windows of a shard: runs that are confirmed, and groups that have to be asked for."""
    import ahocorasick

    automaton, texts = ahocorasick.Automaton(), []
    for key, (copies, raw, phrases_wanted) in chunk.items():
        words = words_of(raw)
        rolling = Rolling(hashed(words))
        phrases = rolling.at(np.arange(len(words) - PHRASE + 1), PHRASE)
        at = elected(phrases)
        places = np.unique(at)
        for p in places[np.isin(phrases[places], phrases_wanted)].tolist():
            automaton.add_word(f" {b' '.join(words[p : p + PHRASE]).decode('latin-1')} ", 0)
        texts.append((key, copies, words, rolling, at))
    if not len(automaton):
        return
    automaton.make_automaton()
    names, parts = {}, []
    for number, (key, copies, words, rolling, at) in enumerate(texts):
        line = b" %s " % b" ".join(words)
        ends = [end for end, _ in automaton.iter(line.decode("latin-1"))]
        if not ends:
            continue
        spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        located = np.zeros(len(words), bool)
        # a phrase ends with the blank number (start + PHRASE)
        located[np.searchsorted(spaces, ends) - PHRASE] = True
        starts = np.flatnonzero(located[at])
        if not len(starts):
            continue
        anchor = at[starts]
        late = anchor - starts >= ASIDE
        group = np.empty(len(starts), np.uint64)
        group[~late] = rolling.at(anchor[~late], PHRASE + ASIDE - 1)
        group[late] = rolling.at(anchor[late] - ASIDE, PHRASE + ASIDE)
        windows = rolling.at(starts, WINDOW).view(np.int64)
        same = np.ones(len(starts), np.int64)
        parts.append((number * same, starts, group.view(np.int64), windows, min(2, copies) * same))
        names[number] = key
    if not parts:
        return
    doc, start, group, window, weight = (np.concatenate(x) for x in zip(*parts))
    times, first = _times(group, window, weight)
    sure = times >= 2
    if sure.any():
        d, s = doc[sure], start[sure]
        begins, ends = _runs(d, s, None)
        keys = [names[k] for k in d[begins]]
        yield pd.DataFrame(
            {"g": None, "hashes": None, "weight": 2, "key": keys, "first": s[begins], "n": ends - begins}
        )
    for ask, known in ((sure & first, True), (~sure, False)):
        if not ask.any():
            continue
        d, s, g, w = doc[ask], start[ask], group[ask], window[ask]
        begins, ends = _runs(d, s, g)
        yield pd.DataFrame(
            {
                "g": g[begins],
                "hashes": [w[a:b] for a, b in zip(begins, ends)],
                "weight": 2 if known else 1,
                "key": [None if known else names[k] for k in d[begins]],
                "first": s[begins],
                "n": ends - begins,
            }
        )


def _stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cut a task's documents in chunks; equal texts of a chunk are one with a count."""
    columns = ["g", "hashes", "weight", "key", "first", "n"]
    chunk: dict[bytes, list] = {}
    held = 0
    for batch in batches:
        for key, raw, phrases in zip(batch["key"], batch["raw"], batch["phrases"]):
            if key in chunk:
                chunk[key][0] += 1
                continue
            chunk[key] = [1, _unpacked(raw), np.asarray(phrases, np.int64).view(np.uint64)]
            held += len(chunk[key][1])
            if held > CHUNK_BYTES:
                for frame in _locate(chunk):
                    yield frame[columns]
                chunk, held = {}, 0
    for frame in _locate(chunk):
        yield frame[columns]


def _confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come ordered by group; runs of windows that occur more than once in their group."""
    kept = None
    for batch in batches:
        rows = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
        whole = (rows["g"] != rows["g"].iloc[-1]).to_numpy()
        kept = rows[~whole]
        if whole.any():
            yield from _confirmed(rows[whole])
    if kept is not None and len(kept):
        yield from _confirmed(kept)


def _confirmed(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    lengths = rows["n"].to_numpy()
    of = np.repeat(np.arange(len(rows)), lengths)
    window = np.concatenate(rows["hashes"].to_numpy())
    times, _ = _times(rows["g"].to_numpy()[of], window, rows["weight"].to_numpy()[of].astype(np.int64))
    offset = np.arange(len(of)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    yes = (times >= 2) & rows["key"].notna().to_numpy()[of]
    if yes.any():
        d, s = of[yes], rows["first"].to_numpy()[of[yes]] + offset[yes]
        begins, ends = _runs(d, s, None)
        yield pd.DataFrame({"key": rows["key"].to_numpy()[d[begins]], "first": s[begins], "n": ends - begins})


def _packed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Texts as they travel: words are what counts, and compression halves what is shuffled."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=1, write_content_size=True).compress
    for texts in batches:
        yield pd.Series(
            [pack(t.encode("utf-8", "surrogatepass")) if isinstance(t, str) else None for t in texts], dtype=object
        )


def _unpacked(raw: bytes | None) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(raw) if raw else b""


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each document without the words that its runs of windows cover."""
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for raw, runs in zip(batch["raw"], batch["runs"]):
            words = words_of(_unpacked(raw))
            n_words.append(len(words))
            if runs is not None and len(runs):
                steps = np.zeros(len(words) + 1, np.int64)
                for run in runs:
                    steps[run["first"]] += 1
                    steps[run["first"] + run["n"] + WINDOW - 1] -= 1
                covered = np.cumsum(steps)[:-1] > 0
                words = [w for w, c in zip(words, covered) if not c]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words).decode("utf-8", "replace"))
        yield pd.DataFrame({"doc_id": batch["doc_id"], "n_words": n_words, "n_removed": n_removed, "kept": kept})


def repeated_runs(docs: DataFrame) -> DataFrame:
    """key (of the text), runs: stretches of windows that also start elsewhere, as (first, n)."""
    texts = docs.filter("text IS NOT NULL").select(text_key().alias("key"), "text")
    rows = texts.mapInPandas(_phrase_rows, "h long, key binary, weight int")
    times = F.sum("weight").over(Window.partitionBy("h"))
    held = rows.withColumn("times", times).filter("times > 1").groupBy("key").agg(F.collect_set("h").alias("phrases"))
    packed = texts.select("key", F.pandas_udf(_packed, "binary")("text").alias("raw"))
    shards = packed.join(held, "key").select("key", "raw", "phrases")
    located = stored(shards.mapInPandas(_stream, ASKED), "located")
    asked = located.filter("g IS NOT NULL").repartition("g").sortWithinPartitions("g")
    runs = located.filter("g IS NULL").select("key", "first", "n").unionByName(asked.mapInPandas(_confirm, RUNS))
    return runs.groupBy("key").agg(F.collect_set(F.struct("first", "n")).alias("runs"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (what is left, words joined by one blank) of every document."""
    runs = repeated_runs(docs).withColumnRenamed("key", "of")
    raw = F.pandas_udf(_packed, "binary")("text").alias("raw")
    # as strings, ids with nulls among them stay whole in pandas
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_key().alias("key"), raw)
    joined = rows.join(runs, F.col("key") == F.col("of"), "left").select("doc_id", "raw", "runs")
    cut = joined.mapInPandas(_cut, "doc_id string, n_words long, n_removed long, kept string")
    return cut.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def digests(docs: DataFrame) -> DataFrame:
    """The same with a checksum of the kept words in their place."""
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
