"""Token ids in binary shards: one array of ids, document boundaries in Elias-Fano code.

A shard holds the documents of one range of ids in ascending order::

    ids         n_ids numbers of id_width bytes, little-endian, all documents end to end
    doc ids     n_docs signed 64-bit numbers; a bit each that marks nulls
    lows        the low_bits lowest bits of each boundary, packed
    highs       the rest, in unary: bit (boundary >> low_bits) + i is set for the i-th boundary
    samples     position of every SAMPLE-th set bit, 32 bits each
    footer      magic, counts and widths (FOOTER)

The n boundaries (ends of documents) up to u take about 2 + log2(u / n) bits each instead of 64.
select(i) starts at a sample and counts set bits; an offset costs that and one read of the lows.

Rows are dealt by ranges of (doc_id, hash of the text), null ids first, so a shard is one range and
equal ids may spread. Shards are written by the tasks into the cluster's shared folder under a
temporary name and renamed, so that a repeated task leaves one whole file.

Defined cases: null and empty texts hold the end id only; an empty table has no shards; equal rows are
all stored. Memory per task: the boundaries of one shard and one buffer of ids.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import per_process
from tidemark.session import shared_folder

END_ID = 2
SAMPLE = 512
FOOTER = "<8sQQQIIQ"  # magic, docs, ids, bytes of highs, id width, low bits, bytes of lows
MAGIC = b"EFTOKEN1"
BUFFER = 8 << 20
#: Entries kept by an encoder: stretches between white space, and words.
STRETCHES, WORDS = 500_000, 700_000
META = "shard int, path string, docs long, ids long"


class EliasFano:
    """A non-decreasing sequence of whole numbers from 0 to ``top``."""

    def __init__(self, n: int, low_bits: int, lows: np.ndarray, highs: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.lows, self.highs, self.samples = n, low_bits, lows, highs, samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        values = values.astype(np.uint64)
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        lows = np.packbits(bits.astype(np.uint8).reshape(-1), bitorder="little")
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(n + (top >> low_bits) + 1, np.uint8)
        unary[at] = 1
        return cls(n, low_bits, lows, np.packbits(unary, bitorder="little"), at[::SAMPLE].astype(np.uint32))

    def select(self, first: int, count: int) -> np.ndarray:
        """Positions of the set bits number ``first`` to ``first + count - 1``."""
        byte = int(self.samples[first // SAMPLE]) >> 3
        skip = first - first // SAMPLE * SAMPLE
        # set bits of the sample's byte that come before the sample
        skip += int(np.unpackbits(self.highs[byte : byte + 1], bitorder="little")[: int(self.samples[first // SAMPLE]) & 7].sum())
        found, have, step = [], 0, max(64, (skip + count) // 2)
        while have < skip + count:
            part = np.flatnonzero(np.unpackbits(self.highs[byte : byte + step], bitorder="little"))
            found.append(part + byte * 8)
            have += len(part)
            byte += step
        return np.concatenate(found)[skip : skip + count]

    def get(self, first: int, count: int) -> np.ndarray:
        """The values number ``first`` to ``first + count - 1``."""
        if not count:
            return np.zeros(0, np.int64)
        high = self.select(first, count) - np.arange(first, first + count)
        if not self.low_bits:
            return high
        begin, end = first * self.low_bits, (first + count) * self.low_bits
        bits = np.unpackbits(self.lows[begin // 8 : -(-end // 8)], bitorder="little")
        bits = bits[begin % 8 : begin % 8 + end - begin].reshape(count, self.low_bits).astype(np.int64)
        return (high << self.low_bits) | (bits << np.arange(self.low_bits)).sum(axis=1)


class WordEncoder(dict):
    """Stretches between ASCII white space -> packed ids, worked out when first seen.

    The tokenizer drops white space and encodes letters, digits and marks apart, so no id spans two
    stretches. Plain Latin stretches are split here and given to the tokenizer's model; all others go
    through the whole tokenizer.
    """

    plain = re.compile(r"[!-~\xa1-įı-ɏ]+")
    marks = frozenset(bytes([b]) for b in b",.;:!?)")

    def __init__(self, file: str, end_id: int):
        super().__init__()
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.model = self.tokenizer.model
        self.width = 2 if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        self.pack = np.dtype(f"<u{self.width}")
        self.code = "H" if self.width == 2 else "I"
        self.words: dict[str, bytes] = {}
        self.parts = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        # byte-level alphabets show printable bytes as themselves and the others from U+0100 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(shown)]
        self.shown = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(others)}
        self.splits = self._splits_as_expected()

    def _splits_as_expected(self) -> bool:
        """Whether the tokenizer is of the kind that the short way stands for."""
        kind = f"{self.tokenizer.normalizer} {self.tokenizer.pre_tokenizer}"
        return self.parts.pattern in kind and "Lowercase" in kind and "NFC" in kind and "ByteLevel" in kind

    def whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, stretch: bytes) -> bytes:
        """``stretch`` has no A-Z. Letters, with or without one mark behind, are the usual case."""
        if stretch.isalpha():
            packed = self.word(stretch.decode("ascii"))
        elif stretch[:-1].isalpha() and stretch[-1:] in self.marks:
            packed = self.word(stretch[:-1].decode("ascii")) + self.word(stretch[-1:].decode("ascii"))
        else:
            text = stretch.decode("utf-8", "replace")
            if self.plain.fullmatch(text):
                packed = b"".join(map(self.word, self.parts.findall(text.lower())))
            else:
                packed = self.whole(text)
        self[stretch] = packed
        return packed

    def word(self, word: str) -> bytes:
        packed = self.words.get(word)
        if packed is None:
            text = word if word.isascii() else "".join(map(self.shown.__getitem__, word.encode()))
            packed = self.words[word] = array(self.code, [t.id for t in self.model.tokenize(text)]).tobytes()
        return packed

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.splits or "<|" in text:  # what looks like a special token takes the whole way
            return self.whole(text)
        if len(self) > STRETCHES:
            self.clear()
        if len(self.words) > WORDS:
            self.words.clear()
        stretches = text.encode("utf-8", "surrogatepass").lower().split()
        return b"".join(map(self.__getitem__, stretches))


def _files(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def qualified(spark, path: str) -> str:
    """The path with its scheme, as other libraries read it."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    name = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(jpath).toString()
    return re.sub(r"^file:/+", "file:///", name)


def shard_writer(folder: str, tokenizer_file: str, end_id: int) -> Callable:
    """One shard per task; gives its meta row."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = per_process(f"encoder {tokenizer_file} {end_id}", lambda: WordEncoder(tokenizer_file, end_id))
        tail = np.array([end_id], encoder.pack).tobytes()
        files, base = _files(folder)
        shard = TaskContext.get().partitionId()
        path = f"{base}/shard-{shard:06d}.eft"
        ids, nulls, ends, total, out, buffer = [], [], [], 0, None, []
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                if out is None:
                    out = files.open_output_stream(draft := f"{path}.{uuid.uuid4().hex}")
                packed = encoder.encode(text if isinstance(text, str) else None) + tail
                total += len(packed) // encoder.width
                ends.append(total)
                nulls.append(doc_id is None)
                ids.append(0 if doc_id is None else int(doc_id))
                buffer.append(packed)
                held += len(packed)
                if held > BUFFER:
                    out.write(b"".join(buffer))
                    buffer, held = [], 0
        if out is None:
            return
        code = EliasFano.build(np.array(ends, np.int64))
        out.write(b"".join(buffer))
        out.write(np.array(ids, "<i8").tobytes() + np.packbits(nulls, bitorder="little").tobytes())
        out.write(code.lows.tobytes() + code.highs.tobytes() + code.samples.astype("<u4").tobytes())
        out.write(struct.pack(FOOTER, MAGIC, len(ids), total, len(code.highs), encoder.width, code.low_bits, len(code.lows)))
        out.close()
        files.move(draft, path)
        yield pd.DataFrame({"shard": [shard], "path": [f"{folder}/shard-{shard:06d}.eft"], "docs": [len(ids)], "ids": [total]})

    return write


def write_tokens(
    docs: DataFrame, tokenizer_file: str, folder: str | None = None, end_id: int = END_ID
) -> list[tuple[int, str, int, int]]:
    """Write all documents; (shard, path, documents, ids) of every shard, in order."""
    spark = docs.sparkSession
    folder = qualified(spark, folder or f"{shared_folder(spark)}/tokens")
    files, base = _files(folder)
    files.create_dir(base, recursive=True)
    order = [F.col("doc_id").cast("long").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # as strings, ids with nulls among them stay whole in pandas
    named = ranged.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    meta = named.mapInPandas(shard_writer(folder, tokenizer_file, end_id), META).collect()
    return sorted(tuple(r) for r in meta)


class Shard:
    """Random access to a shard: only the parts asked for are read."""

    def __init__(self, path: str):
        files, name = _files(path)
        self.file = files.open_input_file(name)
        size, tail = self.file.size(), struct.calcsize(FOOTER)
        magic, self.docs, self.n_ids, highs, self.width, low_bits, lows = struct.unpack(FOOTER, self._at(size - tail, tail))
        if magic != MAGIC:
            raise ValueError(f"{path} is no token shard")
        self.at_docs = self.n_ids * self.width
        at = self.at_docs + self.docs * 8 + -(-self.docs // 8)
        raw = np.frombuffer(self._at(at, size - tail - at), np.uint8)
        samples = np.frombuffer(raw[lows + highs :].tobytes(), "<u4")
        self.ends = EliasFano(self.docs, low_bits, raw[:lows], raw[lows : lows + highs], samples)

    def _at(self, begin: int, count: int) -> bytes:
        self.file.seek(begin)
        return self.file.read(count)

    def bounds(self, first: int, count: int) -> np.ndarray:
        """count + 1 offsets: where each document begins, and where the last one ends."""
        before = self.ends.get(first - 1, 1) if first else np.zeros(1, np.int64)
        return np.concatenate([before, self.ends.get(first, count)])

    def ids(self, begin: int, end: int) -> np.ndarray:
        return np.frombuffer(self._at(begin * self.width, (end - begin) * self.width), f"<u{self.width}")

    def doc_ids(self, first: int, count: int) -> list[int | None]:
        numbers = np.frombuffer(self._at(self.at_docs + first * 8, count * 8), "<i8")
        bits = np.unpackbits(
            np.frombuffer(self._at(self.at_docs + self.docs * 8, -(-self.docs // 8)), np.uint8), bitorder="little"
        )[first : first + count]
        return [None if null else int(n) for n, null in zip(numbers, bits)]


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, base in zip(batch["path"], batch["base"]):
            shard = Shard(path)
            step = max(1, min(4096, int(BUFFER * shard.docs / max(1, shard.n_ids * shard.width)) + 1))
            for first in range(0, shard.docs, step):
                count = min(step, shard.docs - first)
                bounds = shard.bounds(first, count)
                ids = shard.ids(int(bounds[0]), int(bounds[-1])).astype("<u4")
                cuts = (bounds - bounds[0]).tolist()
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array(shard.doc_ids(first, count), dtype="Int64"),
                        "start": bounds[:-1] + base,
                        "n_tokens": np.diff(bounds),
                        "ids_crc32": [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])],
                    }
                )


def read_index(spark, shards: list[tuple[int, str, int, int]]) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files."""
    rows, base = [], 0
    for _, path, _, ids in shards:
        rows.append((path, base))
        base += ids
    listed = spark.createDataFrame(rows, "path string, base long").repartition(max(1, len(rows)))
    return listed.mapInPandas(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_index(docs: DataFrame, tokenizer_file: str, end_id: int = END_ID) -> DataFrame:
    """Write the shards, then read every document's place and checksum from them."""
    return read_index(docs.sparkSession, write_tokens(docs, tokenizer_file, end_id=end_id))
