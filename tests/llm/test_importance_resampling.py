"""Importance resampling against plain counting and sorting; its query also has SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm.data import COLUMNS, awkward, document, documents, words
from tidemark.llm import importance_resampling as ir
from tidemark.llm.common import stored

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_features(text, longest, buckets):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = WORDS.findall(low)
    runs = [" ".join(found[k : k + n]) for n in range(1, longest + 1) for k in range(len(found) - n + 1)]
    return len(found), [zlib.crc32(r.encode()) % buckets for r in runs]


def plain(rows, targets, percent, least_words, buckets, longest, seed):
    """(doc_id, n_features, weight, score) of all rows, and the drawn ones in order."""
    seen = [(i, *plain_features(t, longest, buckets)) for i, t in rows]
    s = Counter(b for *_, f in seen for b in f)
    t = Counter(b for x in targets for b in plain_features(x, longest, buckets)[1])
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in s}
    scored = []
    for i, n_words, found in seen:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        scored.append((n_words, (i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))))))
    order = sorted((r for n, r in scored if n >= least_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    return [r for _, r in scored], order[: percent * len(order) // 100]


def key(row):
    return tuple((v is not None, v or 0) for v in row)


@pytest.mark.parametrize("longest", [1, 3])
def test_equals_the_plain_version(spark, longest):
    rows = [r[:2] for r in awkward(n=200)]
    targets = ["w1 w2 W3 w4-w5", None, "", "w10 w11 École 日本 w12"]
    options = dict(percent=30, least_words=5, buckets=97, longest=longest, seed=7)
    target = spark.createDataFrame([(t,) for t in targets], "text string")
    got = ir.importance_table(documents(spark, rows), target, **options).collect()
    scored, drawn = plain(rows, targets, **options)
    assert sorted(key(r[:4]) for r in got) == sorted(map(key, scored))
    ranked = sorted((r for r in got if r.rank is not None), key=lambda r: r.rank)
    assert [r.rank for r in ranked] == list(range(1, len(drawn) + 1))
    assert [tuple(r[:4]) for r in ranked] == drawn
    kept = ir.resample(documents(spark, rows), target, **options)
    assert kept.columns == documents(spark, rows).columns
    texts = dict(rows)
    assert sorted(key((r.doc_id, r.text)) for r in kept.collect()) == sorted(key((r[0], texts[r[0]])) for r in drawn)


def test_very_long_texts_in_parts(monkeypatch):
    """Runs across the parts' borders count once."""
    rng = random.Random(2)
    text = " ".join(words(rng, 500)) + " ." * 50 + " x"
    monkeypatch.setattr(ir, "CHUNK_BYTES", 31)
    for longest in (1, 2, 4):
        parts = list(ir.bucket_runs(text, ir.Buckets(1000), longest))
        n_words, found = plain_features(text, longest, 1000)
        assert sum(n for n, _ in parts) == n_words
        assert Counter(b for _, here in parts for b in here.tolist()) == Counter(found)


@pytest.mark.parametrize("kind", ["wide", "narrow", "same", "one", "none"])
def test_radix_sort(spark, kind):
    rng = random.Random(3)
    ends = {"wide": (-(2**63), 2**63 - 1), "narrow": (-40, 40), "same": (5, 5), "one": (1, 1), "none": (0, 0)}[kind]
    n = {"one": 1, "none": 0}.get(kind, 3000)
    rows = [(rng.choice([*ends, rng.randint(*ends)]), rng.randint(0, 5000), k) for k in range(n)]
    table = stored(spark.createDataFrame(rows, "a long, b long, spread long"), "rows")
    got = ir.radix_places(table, [("a", True), ("b", False)], "spread").collect()
    ranked = sorted(got, key=lambda r: r._place)
    assert [r._place for r in ranked] == list(range(n))
    assert [(r.a, r.b) for r in ranked] == sorted(((a, b) for a, b, _ in rows), key=lambda r: (-r[0], r[1]))
    assert sorted(r.spread for r in got) == list(range(n))


def test_a_third_of_the_rows_are_one_row(spark):
    rng = random.Random(5)
    rows = [(k, " ".join(words(rng, 30))) for k in range(200)] + [(7, "w1 w2 w3 " * 10)] * 100
    target = spark.createDataFrame([("w1 w2 w3 " * 9000,)], "text string")
    docs = documents(spark, rows)
    got = [r for r in ir.importance_table(docs, target).collect() if r.rank]
    assert sorted(r.rank for r in got) == list(range(1, 31)) and sum(r.doc_id == 7 for r in got) >= 29
    assert ir.resample(docs, target).count() == 30


def test_names_like_its_own(spark):
    """Every name the operator uses inside, as a column of the caller's."""
    names = "row at _place _block _digit _n _known _id spread weight score rank n_words".split()
    docs = spark.createDataFrame([(k, "a b c " * 9, *range(len(names))) for k in range(50)], ["doc_id", "text", *names])
    target = spark.createDataFrame([("a b",)], "text string")
    kept = ir.resample(docs, target)
    assert kept.columns == docs.columns and {tuple(r[2:]) for r in kept.collect()} == {tuple(range(len(names)))}
    assert kept.count() == 5 and ir.importance_table(docs, target).count() == 50


def test_empty_tables(spark):
    docs, none = documents(spark, awkward()), spark.createDataFrame([], COLUMNS)
    assert ir.importance_table(none, docs).collect() == [] == ir.resample(none, docs).collect()
    assert ir.importance_table(docs, none).count() == docs.count()
    short = spark.createDataFrame([document(1, "too short")], COLUMNS)
    assert [r.rank for r in ir.importance_table(short, docs).collect()] == [None]
    assert ir.resample(short, docs).collect() == []
