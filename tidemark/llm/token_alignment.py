"""Cross-tokenizer alignment: two tokenizers' tokens of a text are coalesced to groups of equal bytes.

Every token is an interval of bytes of a blank and the text. All tokens of both sides are sorted by where they
begin (lexsort), a running maximum of ends (maximum.accumulate) says how far the ones so far reach, and
a group ends where the next token begins at that maximum. Within a group every pair of an A and a B token
that share bytes is expanded; a pair whose ranges end together is a link.

Neither tokenizer joins what a single blank before a visible character divides, so a text is cut there, and
each stretch is encoded and aligned once and remembered; new stretches of many texts are encoded
together and laid end to end for one sort. Tokens that end together are one the other's
ending, so the vocabularies alone tell which links can be: a few hundred thousand, whatever the
corpus. Links are stored as numbers in that list, and the corpus-wide counts are an array over it.

Defined cases: a text that is null or empty, or whose joined tokens of either side aren't a blank and the text, has no
tokens; names of special tokens are text; repeated rows count each; a null id stays null; an empty table
gives an empty one. Memory is bounded by a batch, a megabyte of text (or the longest stretch without a
cut, if that is longer) and the remembered stretches.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import per_process, stored

#: A single blank before an ASCII or Latin character that can be seen: both sides begin a token there.
CUT = re.compile(r"(?<=[^ ])(?= [!-~\xa1-\xac\xae-ɏ])")
PIECE_CHARS = 1 << 20
REMEMBERED = 500_000
#: Longer stretches seldom come again and aren't remembered.
LONGEST_REMEMBERED = 64

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary"
SPANS = "doc_id long, groups array<struct<begin:long,end:long,a:array<int>,b:array<int>>>"
DIGEST = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def byte_level_alphabet() -> dict[str, int]:
    """Printable bytes are shown as themselves, the others by characters from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(others)}


def coalesce(starts: np.ndarray, ends: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """The group of every interval; groups are numbered by where they begin."""
    order = np.lexsort((sides, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.zeros(len(order), np.int64)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks)
    return group


def overlaps(
    starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all A and B intervals that share a byte; both sides ascend and don't overlap themselves."""
    first = np.searchsorted(ends_b, starts_a, "right")
    count = np.maximum(np.searchsorted(starts_b, ends_a, "left") - first, 0)
    a = np.repeat(np.arange(len(starts_a)), count)
    within = np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
    return a, np.repeat(first, count) + within


class Aligner(dict):
    """stretch -> (A tokens, B tokens, groups as text, links), or None where the bytes differ."""

    def __init__(self, file_a: str, file_b: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(file_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=file_b)
        back = byte_level_alphabet()
        size = self.a.get_vocab_size()
        tokens = [self.a.id_to_token(i) or "" for i in range(size)]
        self.bytes_a = [bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for t in tokens]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        ]
        self.width_a, self.width_b = (np.array([len(t) for t in ts]) for ts in (self.bytes_a, self.bytes_b))
        self.pairs = self._possible_links()
        self.most = max(len(self.bytes_a), len(self.bytes_b))
        #: An id and what follows it: another of its side, the other side, or another group.
        self.names = [f"{i}{mark}" for mark in ",|;" for i in range(self.most)]
        self.older: dict[str, tuple | None] = {}

    def _possible_links(self) -> np.ndarray:
        """Sorted A id * B vocabulary + B id of all pairs of which one token ends with the other."""

        def by_bytes(tokens: list[bytes]) -> dict[bytes, list[int]]:
            ids: dict[bytes, list[int]] = {}
            for i, token in enumerate(tokens):
                ids.setdefault(token, []).append(i)
            return ids

        ids_a, ids_b = by_bytes(self.bytes_a), by_bytes(self.bytes_b)
        n = len(self.bytes_b)
        found = {a * n + b for a, t in enumerate(self.bytes_a) for k in range(len(t)) for b in ids_b.get(t[k:], ())}
        found |= {a * n + b for b, t in enumerate(self.bytes_b) for k in range(len(t)) for a in ids_a.get(t[k:], ())}
        return np.array(sorted(found), np.int64)

    def learn(self, stretches: list[str]) -> None:
        """Encode and align new stretches, all in one go."""
        all_a = [e.ids for e in self.a.encode_batch_fast(stretches, add_special_tokens=False)]
        all_b = self.b.encode([s[1:] for s in stretches], num_threads=1)  # it puts the blank before the text itself
        raw = [s.encode() for s in stretches]
        same = [
            b"".join(map(self.bytes_a.__getitem__, ids_a)) == r == b"".join(map(self.bytes_b.__getitem__, ids_b))
            for ids_a, ids_b, r in zip(all_a, all_b, raw)
        ]
        self.update((s, None) for s, ok in zip(stretches, same) if not ok)
        stretches, all_a, all_b = ([x for x, ok in zip(xs, same) if ok] for xs in (stretches, all_a, all_b))
        if not stretches:
            return
        n_a, n_b = list(map(len, all_a)), list(map(len, all_b))
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (all_a, all_b))
        ends_a, ends_b = np.cumsum(self.width_a[a]), np.cumsum(self.width_b[b])
        starts_a, starts_b = ends_a - self.width_a[a], ends_b - self.width_b[b]
        sides = np.repeat([0, 1], [len(a), len(b)])
        group = coalesce(np.concatenate([starts_a, starts_b]), np.concatenate([ends_a, ends_b]), sides)
        i, j = overlaps(starts_a, ends_a, starts_b, ends_b)
        together = ends_a[i] == ends_b[j]
        i, j = i[together], j[together]
        packed = np.searchsorted(self.pairs, a[i] * len(self.bytes_b) + b[j]).astype("<u4").tobytes()
        # a group's A ids, then its B ids; what follows an id tells whether side or group end with it
        order = np.argsort(group, kind="stable")
        group, side = group[order], sides[order]
        after = np.full(len(order), 2)
        after[:-1] = np.where(group[1:] > group[:-1], 2, side[1:] > side[:-1])
        shown = (after * self.most + np.concatenate([a, b])[order]).tolist()
        # a stretch ends where both sides do, so its groups and links are its own
        link_at = (4 * np.searchsorted(i, np.cumsum([0, *n_a]))).tolist()
        name = self.names.__getitem__
        begin = 0
        for k, (stretch, ta, tb) in enumerate(zip(stretches, n_a, n_b)):
            end = begin + ta + tb
            self[stretch] = (ta, tb, "".join(map(name, shown[begin:end])), packed[link_at[k] : link_at[k + 1]])
            begin = end

    def pieces(self, text: str) -> Iterator[str]:
        """A blank and the text, about a megabyte at a time, divided at cuts."""
        text = " " + text
        begin = 0
        while begin < len(text):
            cut = CUT.search(text, begin + PIECE_CHARS)
            end = cut.start() if cut else len(text)
            yield text[begin:end]
            begin = end

    def align(self, texts: list[str | None]) -> Iterator[tuple[int, list[tuple | None]]]:
        """(number of the text, what its stretches align to) for consecutive parts of every text with tokens."""
        work: list[tuple[int, list[str]]] = []
        held = 0
        for i, text in enumerate(texts):
            for piece in self.pieces(text) if text else ():
                work.append((i, CUT.split(piece)))
                held += len(piece)
                if held >= PIECE_CHARS:
                    yield from self._aligned(work)
                    work, held = [], 0
        yield from self._aligned(work)

    def _aligned(self, work: list[tuple[int, list[str]]]) -> Iterator[tuple[int, list[tuple | None]]]:
        if len(self) > REMEMBERED // 2:  # what isn't met again until the next turn is forgotten
            self.older = dict(self)
            self.clear()
        new = set(chain.from_iterable(s for _, s in work)).difference(self)
        again = new.intersection(self.older)
        self.update((s, self.older[s]) for s in again)
        new = list(new - again)
        if new:
            self.learn(new)
        for i, stretches in work:
            yield i, list(map(self.__getitem__, stretches))
        for stretch in new:
            if len(stretch) > LONGEST_REMEMBERED:
                del self[stretch]


def _aligner(file_a: str, file_b: str) -> Aligner:
    return per_process(f"aligner {file_a} {file_b}", lambda: Aligner(file_a, file_b))


def _digests(file_a: str, file_b: str) -> Callable:
    schema = pa.schema(
        [("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups"))]
        + [("groups_sha256", pa.string()), ("links", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(file_a, file_b)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts = np.zeros((3, len(texts)), np.int64)
            hashes, links, bad = {}, {}, set()
            for i, parts in aligner.align(texts):
                if i in bad or None in parts:
                    bad.add(i)
                    continue
                n_a, n_b, groups, linked = zip(*parts)
                packed = b"".join(linked)
                text = "".join(groups)[:-1].encode()
                if i in hashes:
                    hashes[i].update(b";" + text)
                    links[i].append(packed)
                else:
                    hashes[i], links[i] = hashlib.sha256(text), [packed]
                counts[:, i] += sum(n_a), sum(n_b), len(packed) // 4  # a link ends each group
            for i in bad:
                counts[:, i] = 0
                hashes.pop(i, None), links.pop(i, None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *map(pa.array, counts),
                    pa.array([hashes[i].hexdigest() if i in hashes else "" for i in range(len(texts))], pa.string()),
                    pa.array([b"".join(links.pop(i, ())) for i in range(len(texts))], pa.binary()),
                ],
                schema=schema,
            )

    return run


def _spans(file_a: str, file_b: str) -> Callable:
    group = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(file_a, file_b)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found: list[list] = [[] for _ in texts]
            bad = set()
            for i, parts in aligner.align(texts):
                if i in bad or None in parts:
                    bad.add(i)
                    continue
                for _, _, groups, _ in parts:
                    for one in groups[:-1].split(";"):
                        a, b = ([int(x) for x in side.split(",")] for side in one.split("|"))
                        begin = found[i][-1]["end"] if found[i] else 0
                        found[i].append({"begin": begin, "end": begin + int(aligner.width_a[a].sum()), "a": a, "b": b})
            for i in bad:
                found[i] = []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(group))], names=["doc_id", "groups"])

    return run


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def alignments(docs: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """doc_id, groups: byte offsets in a blank and the text, and the ids of either side."""
    return _rows(docs).mapInArrow(_spans(file_a, file_b), SPANS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a task's documents add to each link's count."""
    sums = np.zeros(0, np.int64)
    for batch in batches:
        here = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4"))
        if len(here) > len(sums):
            sums, here = here, sums
        sums[: len(here)] += here
    link = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(link, pa.int64()), pa.array(sums[link], pa.int64())], names=["link", "n"])


def link_counts(aligned: DataFrame, pairs: int) -> np.ndarray:
    """How many links of all documents each possible one has; the result has ``pairs`` numbers at most."""
    sums = aligned.select("links").mapInArrow(_count, "link long, n long").groupBy("link").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(pairs, np.int64)
    counts[sums["link"].to_numpy()] = sums["n"].to_numpy()
    return counts


def best_links(counts: np.ndarray, ids_b: np.ndarray, size_b: int) -> np.ndarray:
    """Which links have their B id's highest count."""
    highest = np.zeros(size_b, np.int64)
    np.maximum.at(highest, ids_b, counts)
    return counts == highest[ids_b]


def _rated(counts: np.ndarray, best: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column("links").to_pylist()
            ends = np.cumsum([len(p) // 4 for p in packed])
            links = np.frombuffer(b"".join(packed), "<u4")

            def summed(values: np.ndarray) -> np.ndarray:
                sums = np.concatenate([[0], np.cumsum(values[links], dtype=np.int64)])
                return np.diff(sums[np.concatenate([[0], ends])])

            columns = {n: batch.column(n) for n in ("doc_id", "n_a", "n_b", "n_groups")}
            columns["n_links"] = pa.array(np.diff(ends, prepend=0))
            columns["n_best"], columns["count_sum"] = pa.array(summed(best)), pa.array(summed(counts))
            columns["groups_sha256"] = batch.column("groups_sha256")
            yield pa.RecordBatch.from_pydict(columns)

    return run


def alignment_table(docs: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """Numbers of tokens, groups and links of every document, and how common its links are in the corpus."""
    aligned = stored(_rows(docs).mapInArrow(_digests(file_a, file_b), ALIGNED), "aligned")
    aligner = _aligner(file_a, file_b)
    size_b = len(aligner.bytes_b)
    counts = link_counts(aligned, len(aligner.pairs))
    best = best_links(counts, aligner.pairs % size_b, size_b)
    return aligned.mapInArrow(_rated(counts, best), DIGEST)
