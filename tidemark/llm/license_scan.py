"""License scans: short notices in texts, with a bounded number of typing errors.

A text becomes a line of words: A-Z lower-cased, words are runs of characters outside
``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``. Every place where a notice's words stand consecutively is found
first. For the inexact ones a notice may hold e errors of characters; cut in e + 1 seeds, one seed must
stand unchanged (pigeonhole). Where a seed stands, the regex library verifies the notice with at most e
errors around it and reports the span. A match must begin and end at word boundaries and hold the
notice's fixed words (names and version numbers) unchanged, so that other versions aren't mistaken.

Defined cases: null is an empty text; texts without a match get 0, nulls, empty labels and score 0;
very long texts are scanned whole. The score is 1 for an exact place, else the best share of characters
that are right.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Notices that may hold errors: phrase, label, words that must be right.
NOTICES = (
    ("under the mit license", "mit", ("mit",)),
    ("apache license version 2", "apache-2", ("2",)),
    ("gnu general public license version 2", "gpl-2", ("gnu", "2")),
    ("gnu general public license version 3", "gpl-3", ("gnu", "3")),
    ("gnu lesser general public license", "lgpl", ("gnu",)),
    ("mozilla public license version 2", "mpl-2", ("2",)),
    ("redistribution and use in source and binary forms", "bsd", ()),
    ("creative commons attribution noncommercial", "cc-by-nc", ()),
)
CHARACTERS_PER_ERROR = 8

SPAN = "label:string,first_word:bigint,last_word:bigint,errors:int"
RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
    f" score double, spans array<struct<{SPAN}>>"
)

#: By byte: lower-cased letter, digit or part of another character; blank for what separates words.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


@dataclass
class Notice:
    phrase: bytes
    label: str
    fixed: tuple[bytes, ...]
    errors: int
    seeds: list[tuple[int, bytes]]


def notice(phrase: str, label: str, fixed: tuple[str, ...]) -> Notice:
    raw = phrase.encode()
    errors = len(raw) // CHARACTERS_PER_ERROR
    ends = [len(raw) * k // (errors + 1) for k in range(errors + 2)]
    seeds = [(a, raw[a:b]) for a, b in zip(ends, ends[1:])]
    return Notice(raw, label, tuple(f.encode() for f in fixed), errors, seeds)


def line_of(text: str | None) -> tuple[bytes, int]:
    """The words between single blanks, with a blank at either end, and how many there are."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()
    return b" %s " % b" ".join(words), len(words)


def places(line: bytes, phrase: bytes) -> Iterator[int]:
    """Where the phrase's words stand consecutively, overlaps included."""
    wanted = b" %s " % phrase
    at = line.find(wanted)
    while at >= 0:
        yield at + 1
        at = line.find(wanted, at + 1)


def fuzzy(line: bytes, one: Notice, pattern) -> Iterator[tuple[int, int, int]]:
    """(begin, end, errors) of the notice's inexact places."""
    m, e = len(one.phrase), one.errors
    done = -1  # regions up to here have been verified
    starts = sorted({at - offset for offset, seed in one.seeds for at in _finds(line, seed)})
    for start in starts:
        if start <= done:
            continue
        low, high = max(0, start - e - 1), min(len(line), start + m + 2 * e + 1)
        found = pattern.search(line, low, high)
        if not found:
            continue
        begin, end = found.span("notice")
        words = line[begin:end].split()
        if all(f in words for f in one.fixed):
            yield begin, end, sum(found.fuzzy_counts)
            done = begin


def _finds(line: bytes, seed: bytes) -> Iterator[int]:
    at = line.find(seed)
    while at >= 0:
        yield at
        at = line.find(seed, at + 1)


class Scanner:
    def __init__(self) -> None:
        import regex

        self.base = [(p.encode(), label) for p, label in BASE.items()]
        self.notices = [notice(*n) for n in NOTICES]
        self.patterns = [
            # the blanks around are exact, so errors fall inside the notice
            regex.compile(
                rb"(?b)(?<= )(?P<notice>(?:%s){e<=%d})(?= )" % (regex.escape(n.phrase, special_only=True), n.errors)
            )
            for n in self.notices
        ]

    def scan(self, text: str | None) -> tuple:
        line, n_words = line_of(text)
        word_at = lambda at: line.count(b" ", 0, at) - 1
        spans, starts, base, labels, score = [], [], set(), set(), 0.0
        for phrase, label in self.base:
            for at in places(line, phrase):
                first = word_at(at)
                starts.append(first)
                base.add(label)
                spans.append({"label": label, "first_word": first, "last_word": first + phrase.count(b" "), "errors": 0})
                score = 1.0
        exact = {(s["label"], s["first_word"]) for s in spans}
        for one, pattern in zip(self.notices, self.patterns):
            for begin, end, errors in fuzzy(line, one, pattern):
                first = word_at(begin)
                labels.add(one.label)
                if (one.label, first) not in exact:
                    last = first + len(line[begin:end].split()) - 1
                    spans.append({"label": one.label, "first_word": first, "last_word": last, "errors": errors})
                    score = max(score, 1 - errors / len(one.phrase))
        return (
            n_words,
            len(starts),
            min(starts, default=None),
            max(starts, default=None),
            ",".join(sorted(base)),
            ",".join(sorted(base | labels)),
            score,
            spans,
        )


def scan_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    scanner = Scanner()
    for texts in batches:
        rows = [scanner.scan(t) for t in texts]
        frame = pd.DataFrame(
            rows,
            columns=["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
        )
        yield frame.astype({"first_word": "Int64", "last_word": "Int64"})


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id and, per document, base places, labels, score and the spans of all matches."""
    return docs.select("doc_id", F.pandas_udf(scan_batches, RESULT)("text").alias("s")).select("doc_id", "s.*")
