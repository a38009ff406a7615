"""Benchmark decontamination: find test items in documents, with a bounded number of word edits.

An item of m words may differ by k = floor(m * ``TOLERANCE``) inserted, deleted or replaced words. Cut
in k + 1 pieces, at least one piece must stand in the document unchanged (pigeonhole). One automaton
over all pieces finds those exact hits; around each, Myers' bit-parallel algorithm, a whole column of
the edit table in one integer, gives the smallest distance and where the match ends; the same on the
reversed words gives its start.

Words are runs of letters and digits after lower-casing; in scripts that put no blanks between words every
character is one. An item of few words has no budget and must stand in the document as it is; only items whose
words have under ``LEAST_BYTES`` bytes together are no evidence and match nothing; null and empty texts match nothing; equal items are all reported, and
equal documents are treated alike. Items are dealt to blocks of about ``BLOCK_BYTES`` by hash; a block
is what one automaton holds and what is sent to executors, and documents are streamed once per block.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

TOLERANCE = 0.15
LEAST_BYTES = 12
BLOCK_BYTES = 4_000_000
MATCH = "array<struct<item_id:bigint,distance:int,first_word:int,last_word:int>>"

#: ASCII letters and digits and all bytes of other characters stay; the rest separates words.
_KEEP = bytes(b if chr(b).isalnum() or b >= 0x80 else 32 for b in range(128)) + bytes(range(128, 256))

#: Thai, Lao, Burmese, Khmer, kana and ideographs.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def words_of(text: str) -> list[str]:
    """Each word as one character per UTF-8 byte."""
    if not text.isascii():
        text = UNSPACED.sub(r" \g<0> ", text)
    return text.lower().encode("utf-8", "surrogatepass").translate(_KEEP).decode("latin-1").split()


def pieces_of(words: list[str], parts: int) -> Iterator[tuple[int, list[str]]]:
    """(offset, words) of nearly equal consecutive parts."""
    ends = [len(words) * p // parts for p in range(parts + 1)]
    for a, b in zip(ends, ends[1:]):
        yield a, words[a:b]


def myers(masks: dict[str, int], m: int, words: list[str]) -> tuple[int, int]:
    """Smallest edit distance of a pattern of m words to any stretch of the words; its last end.

    ``masks`` has, by word, the pattern positions that hold it. Of equal distances the last end wins.
    """
    top = 1 << (m - 1)
    full = (1 << m) - 1
    up, down, score = full, 0, m
    best, at = m, -1
    for j, word in enumerate(words):
        eq = masks.get(word, 0)
        x = eq | down
        d0 = ((((x & up) + up) ^ up) | x) & full
        plus, minus = down | (full & ~(d0 | up)), up & d0
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up, down = minus | (full & ~(d0 | plus)), plus & d0
        if score <= best:
            best, at = score, j
    return best, at


def masks_of(words: list[str]) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, word in enumerate(words):
        masks[word] = masks.get(word, 0) | 1 << i
    return masks


class Items:
    """The items of one block, compiled on an executor when first used."""

    def __init__(self, items: list[tuple[int, str]], tolerance: float):
        import ahocorasick

        self.words, self.budget, self.ids = [], [], []
        places: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            words = words_of(text)
            if sum(map(len, words)) < LEAST_BYTES:
                continue
            k = int(len(words) * tolerance)
            for offset, piece in pieces_of(words, k + 1):
                places.setdefault(f" {' '.join(piece)} ", []).append((len(self.ids), offset))
            self.ids.append(item_id)
            self.words.append(words)
            self.budget.append(k)
        self.masks = [masks_of(w) for w in self.words]
        self.backward = [masks_of(w[::-1]) for w in self.words]
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def matches(self, text: str | None) -> list[dict]:
        """One entry per item found: its smallest distance, and of those places the last."""
        if not text or not self.ids:
            return []
        words = words_of(text)
        line = f" {' '.join(words)} "
        hits = [(end - length + 1, where) for end, (length, where) in self.automaton.iter(line)]
        if not hits:
            return []
        spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
        found: dict[int, tuple[int, int, int]] = {}
        tried: set[tuple[int, int]] = set()
        for begin, where in hits:
            at = int(np.searchsorted(spaces, begin))
            for item, offset in where:
                if (item, at - offset) in tried:
                    continue
                tried.add((item, at - offset))
                k, m = self.budget[item], len(self.words[item])
                low = max(0, at - offset - k)
                window = words[low : at - offset + m + k]
                distance, last = myers(self.masks[item], m, window)
                if distance > k:
                    continue
                _, length = myers(self.backward[item], m, window[last::-1][: m + k])
                place = (-distance, low + last, low + last - length)
                if item not in found or place > found[item]:
                    found[item] = place
        return [
            {"item_id": self.ids[i], "distance": -d, "first_word": first, "last_word": last}
            for i, (d, last, first) in sorted(found.items())
        ]


def matcher(items: list[tuple[int, str]], tolerance: float = TOLERANCE) -> Callable[[Column], Column]:
    """Column function: text -> the items found in it."""

    @F.pandas_udf(MATCH)
    def matched(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        block = Items(items, tolerance)
        for texts in batches:
            yield pd.Series([block.matches(t) for t in texts], dtype=object)

    return matched


def blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items, one bounded block at a time."""
    usable = items.filter("text IS NOT NULL").select(F.col("item_id").cast("long"), "text")
    total = usable.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // BLOCK_BYTES)
    for b in range(n):
        block = usable.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == b)
        yield [(r["item_id"], r["text"]) for r in block.orderBy("item_id", "text").collect()]


def contaminations(docs: DataFrame, items: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, item_id, distance, first_word, last_word: a row for each item found in a document."""
    result = None
    for block in blocks(items):
        found = (
            docs.select("doc_id", F.explode(matcher(block, tolerance)("text")).alias("m"))
            .select("doc_id", "m.*")
        )
        result = found if result is None else result.unionByName(found)
    if result is None:
        empty = F.lit(None).cast(MATCH)
        return docs.select("doc_id", F.explode(empty).alias("m")).select("doc_id", "m.*")
    return result


def drop_contaminated(docs: DataFrame, items: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """The rows in which no item is found, columns unchanged."""
    for k, block in enumerate(blocks(items)):
        if k:
            docs = stored(docs, "clean-of-blocks")  # one automaton in memory at a time
        docs = docs.filter(F.size(matcher(block, tolerance)("text")) == 0)
    return docs
