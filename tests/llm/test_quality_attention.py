"""The quality classifier: features and gradient against plain versions, held-out accuracy, odd tables."""

import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.data import COLUMNS, awkward, documents, words
from tidemark.llm import quality_attention as qa
from tidemark.llm.queries import QUERIES


def plain_features(text):
    """Passage by passage, word by word; for texts of one stretch."""
    raw = text.encode()
    blank = set(b" \t\n\v\f\r")
    spans, begin = [], None
    for k, b in enumerate(raw + b"\n"):
        if b in blank:
            if begin is not None:
                spans.append((begin, k))
            begin = None
        elif begin is None:
            begin = k
    rows = []
    for first in range(0, max(1, len(spans)), qa.PASSAGE_WORDS):
        part = spans[first : first + qa.PASSAGE_WORDS]
        lowest = spans[first][0] if first else 0
        highest = spans[first + qa.PASSAGE_WORDS][0] if first + qa.PASSAGE_WORDS < len(spans) else len(raw) + 1
        padded = b"\n" + raw + b"\n"
        pairs = Counter(int(qa.KIND[padded[k]]) * qa.KINDS + int(qa.KIND[padded[k + 1]]) for k in range(lowest, highest))
        x = np.zeros(qa.FEATURES)
        for pair, n in pairs.items():
            x[pair] = (n / (highest - lowest)) ** 0.5
        if part:
            found = [raw[a:b] for a, b in part]
            all_words = [raw[a:b] for a, b in spans]
            for k, back in enumerate((1, 2)):
                x[-6 + k] = np.mean([i >= back and all_words[i] == all_words[i - back] for i in range(first, first + len(part))])
            x[-4] = len(set(found)) / len(found)
            x[-3] = min(np.mean([len(w) for w in found]) / 16, 4)
            x[-2] = len(found) / qa.PASSAGE_WORDS
            x[-1] = np.mean([len(w) > 24 for w in found])
        rows.append(x)
    return np.array(rows)


def test_features_equal_the_plain_version():
    rng = random.Random(1)
    texts = ["", "  \n ", "x", " lead and trail ", "ÉCOLE école 日本 😀\r\nline", "same " * 70, "a" * 300 + " b b b a b a"]
    texts += [" ".join(words(rng, n, 9)) for n in (1, 63, 64, 65, 128, 200)] + ["\n\n".join(words(rng, 150, 5)) + "\n"]
    x, sizes = qa.encode([t.encode() for t in texts])
    parts = np.split(x, np.cumsum(sizes)[:-1])
    for text, part in zip(texts, parts):
        assert np.allclose(part, plain_features(text), atol=1e-6), text[:40]


def test_gradient_against_differences():
    rng = np.random.default_rng(0)
    p = qa.fresh(rng, 5, 4, 3)
    args = rng.normal(size=(9, 5)), np.array([0, 2, 3, 7]), np.array([0, 1, 1, 0.0]), np.array([1, 2, 0.5, 1]), 0.1
    _, grad = qa.loss_and_gradient(p, *args)
    for name, value in p.items():
        for at in np.ndindex(value.shape):
            sides = []
            for d in (1e-6, -1e-6):
                moved = {k: v.copy() for k, v in p.items()}
                moved[name][at] += d
                sides.append(qa.loss_and_gradient(moved, *args)[0])
            assert abs((sides[0] - sides[1]) / 2e-6 - grad[name][at]) < 1e-7


def some_model(constant=None):
    return qa.Model(weights=qa.fresh(np.random.default_rng(4)), constant=constant)


def test_scores_equal_whole_bags(monkeypatch):
    """The softmax carried along stretches is that of all passages at once."""
    rng = random.Random(2)
    texts = ["", None, " ", *(" ".join(words(rng, rng.randrange(1, 400))) for _ in range(20)), "x" * 900 + " y"]
    monkeypatch.setattr(qa, "STRETCH_BYTES", 400)
    model = some_model()
    got = qa.Scorer(model).score(texts)
    for text, score in zip(texts, got):
        x, _ = qa.encode(list(qa.stretches(text)))
        h, e = qa.forward(model.weights, x)
        share = np.exp(e) / np.exp(e).sum()
        assert abs(score - qa.sigmoid(share @ h @ model.weights["c"] + model.weights["d"])[0]) < 1e-9
    for text in texts[3:]:
        assert b"".join(qa.stretches(text)) == text.encode()
    assert qa.Scorer(some_model(0.25)).score(texts[:2]).tolist() == [0.25, 0.25]


def junk_table(spark, n=1000, copies=False):
    rng = random.Random(9)
    rows, labels = awkward(), []
    spoil = [lambda w: w + "$$$", lambda w: w.upper() + "!!", lambda w: w + " |"]
    for k in range(n):
        text, bad = words(rng, rng.randrange(30, 300)), k % 7 == 0
        if bad:
            way = rng.choice(spoil)
            half = len(text) // 2 * (k % 2)  # in some only the second half is bad
            text = text[:half] + [way(w) for w in text[half:]]
        if copies and k % 3 == 1:
            text, bad = ["copy$$$"] * 80, True
        rows.append((10_000 + k, " ".join(text), "src1"))
        labels.append((10_000 + k, int(not bad), 0, "extra"))
    labels += [(None, 1, 1, ""), (10_000, None, 1, ""), (999_999, 0, 1, ""), (1000, 1, 0, ""), (10_001, 1, 0, "again")]
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, score string")


@pytest.mark.parametrize("copies", [False, True])
def test_junk_is_learned(spark, copies):
    docs, labels = junk_table(spark, copies=copies)
    got = qa.score_table(docs, labels).collect()
    assert len(got) == docs.count() and {r.held_out for r in got} == {True, False}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    truth = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    judged = [(r, truth[r.doc_id]) for r in got if r.held_out and r.doc_id is not None and 10_002 <= r.doc_id < 900_000]
    assert sum(r.predicted == y for r, y in judged) >= 0.97 * len(judged)
    kept = qa.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got)


def test_labels_are_no_inputs(spark):
    """Labels, source and language of held-out rows change nothing."""
    docs, labels = junk_table(spark, 300)
    held = labels.filter(~qa.may_learn())
    turned = labels.filter(qa.may_learn()).unionByName(held.selectExpr("doc_id", "1 - quality AS quality", "toxic", "score"))
    other = docs.selectExpr("doc_id", "text", "'xx' AS lang", "'yy' AS source")
    score = lambda d, l: sorted(((r.doc_id or -1, r.score) for r in qa.score_table(d, l).collect()))  # noqa: E731, E741
    assert score(docs, labels) == score(other, turned)


def test_without_labels(spark):
    docs = documents(spark, awkward())
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in qa.score_table(docs, none).collect()} == {0.0}
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    assert {r.score for r in qa.score_table(docs, one).collect()} == {1.0}
    assert qa.score_table(spark.createDataFrame([], COLUMNS), one).collect() == []


def test_held_out_accuracy(spark, sf_dir):
    base = sf_dir.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{base}/labels.parquet")
    got = QUERIES["op13_quality_attention"](spark, base).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) / len(got) > 0.95
