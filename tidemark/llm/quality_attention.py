"""Quality classifier: attention-based multiple-instance learning over a document's passages.

A document is a bag of passages of 64 words, and only bags have labels. Every passage is encoded: shares of
pairs of neighbouring bytes by kind (small letter, capital, digit, blank, mark ...) and shares of repeated and
new words go through a dense layer. Gated attention, tanh(V h) times sigmoid(U h) under a softmax over the
passages, weighs them, and a logistic unit scores the weighted sum of the encoded passages. Encoder, attention and
score are learned together from the documents' labels by their exact gradient.

Inputs of a score are texts only. Learning uses at most ``SAMPLE_TEXTS`` different labelled texts of either class,
picked by the hash of the text, and of each at most ``SAMPLE_PASSAGES`` passages, evenly spread over it; class
frequencies are counted over all labelled rows, copies included. Scoring reads every passage of every text; the
softmax is carried along a text, so memory is bounded by a batch and a megabyte of text.

A text is read in stretches of a megabyte, ended at white space; passages begin anew with each stretch.

Defined cases: a null, empty or blank text is one passage without words; labels that are null or without a document
are left out, and a null id isn't held out; a document labelled more than once counts as low quality if any label
says so; with no labels of one class every score is the share of quality labels (0 with no labels at all).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

SAMPLE_TEXTS = 3_000
SAMPLE_PASSAGES = 24
PASSAGE_WORDS = 64
THRESHOLD = 0.3
STRETCH_BYTES = 1 << 20
HIDDEN = 24
GATES = 12
ROUNDS = 30
SCORED = "doc_id long, score double"


def _kinds() -> np.ndarray:
    """The kind of every byte of UTF-8; bytes that follow another one are told apart by their upper half."""
    kind = np.full(256, 15, np.int64)
    groups = (
        b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r\v\f",
        b".", b",;:", b"'\"()[]{}", b"!?", b"#$%&*@^~`=+<>\\_", b"|/-",
    )
    for k, group in enumerate(groups):
        kind[list(group)] = k
    kind[0x80:0xA0], kind[0xA0:0xC0], kind[0xC2:0xC5], kind[0xC5:0xF5] = 11, 12, 13, 14
    return kind


KIND = _kinds()
KINDS = 16
FEATURES = KINDS * KINDS + 6
#: White space that divides words.
BLANK = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
#: Odd multipliers that give every place of a word its own weight.
PLACES = np.random.default_rng(13).integers(1, 1 << 62, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def stretches(text: str | None) -> Iterator[bytes]:
    """The text in UTF-8, a megabyte at a time; a blank text as nothing."""
    raw = (text or "").encode()
    if len(raw) <= STRETCH_BYTES:
        yield raw
        return
    begin = 0
    while begin < len(raw):
        end = begin + STRETCH_BYTES
        if end < len(raw):
            ahead = BLANK[np.frombuffer(raw, np.uint8, min(STRETCH_BYTES, len(raw) - end), end)]
            end += int(ahead.argmax()) if ahead.any() else len(ahead)
        yield raw[begin:end]
        begin = end


def encode(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages, how many of them each stretch has)."""
    raw = np.frombuffer(b"\n" + b"\n".join(raws) + b"\n", np.uint8)
    sizes = np.array([len(r) + 1 for r in raws])
    owner = np.repeat(np.arange(len(raws)), sizes)  # of the bytes from 1 on
    blank = BLANK[raw]
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    word_owner = owner[starts - 1]
    words = np.bincount(word_owner, minlength=len(raws))
    passages = np.maximum(1, -(-words // PASSAGE_WORDS))
    base = np.cumsum(passages) - passages
    number = np.arange(len(starts)) - np.repeat(np.cumsum(words) - words, words)
    word_passage = base[word_owner] + number // PASSAGE_WORDS
    total = int(passages.sum())
    # a byte belongs to the passage of the word that last began; what stands before a text's first word to its first
    began = np.zeros(len(raw), np.int64)
    began[starts] = 1
    last = np.cumsum(began)[1:]
    at = base[owner].copy()
    if len(starts):
        of_last = word_passage[np.maximum(last, 1) - 1]
        own = (last > 0) & (word_owner[np.maximum(last, 1) - 1] == owner)
        at[own] = of_last[own]
    kind = KIND[raw]
    pair = kind[:-1] * KINDS + kind[1:]
    features = np.zeros((total, FEATURES), np.float32)
    pairs = np.bincount(at * (KINDS * KINDS) + pair, minlength=total * KINDS * KINDS).reshape(total, -1)
    length = pairs.sum(axis=1, keepdims=True)
    features[:, : KINDS * KINDS] = np.sqrt(pairs / np.maximum(length, 1))
    if len(starts):
        ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
        lengths = ends - starts
        place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        letters = (raw[~blank].astype(np.uint64) + np.uint64(1)) * PLACES[place % 256]
        names = np.add.reduceat(letters, np.cumsum(lengths) - lengths)
        names ^= names >> np.uint64(29)
        n = np.bincount(word_passage, minlength=total)
        share = lambda which: np.bincount(word_passage, which, total) / np.maximum(n, 1)
        for k, back in enumerate((1, 2)):
            again = np.zeros(len(names))
            again[back:] = (names[back:] == names[:-back]) & (word_owner[back:] == word_owner[:-back])
            features[:, KINDS * KINDS + k] = share(again)
        order = np.lexsort((names, word_passage))
        new = np.ones(len(names))
        new[order[1:]] = (names[order][1:] != names[order][:-1]) | (word_passage[order][1:] != word_passage[order][:-1])
        features[:, KINDS * KINDS + 2] = share(new)
        features[:, KINDS * KINDS + 3] = np.minimum(share(lengths) / 16, 4)
        features[:, KINDS * KINDS + 4] = n / PASSAGE_WORDS
        features[:, KINDS * KINDS + 5] = share(lengths > 24)
    return features, passages


@dataclass
class Model:
    """Mean and spread of features, then encoder, attention and score; or one score for all."""

    mean: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    spread: np.ndarray = field(default_factory=lambda: np.ones(FEATURES))
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    constant: float | None = None


def fresh(rng: np.random.Generator, features: int = FEATURES, hidden: int = HIDDEN, gates: int = GATES) -> dict[str, np.ndarray]:
    """Small random weights: encoder (w, b), attention (v, u, a), score (c, d)."""
    return {
        "w": rng.normal(0, features**-0.5, (features, hidden)), "b": np.zeros(hidden),
        "v": rng.normal(0, hidden**-0.5, (hidden, gates)), "u": rng.normal(0, hidden**-0.5, (hidden, gates)),
        "a": rng.normal(0, gates**-0.5, gates), "c": rng.normal(0, hidden**-0.5, hidden), "d": np.zeros(1),
    }


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(p: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(encoded passages, their attention before the softmax)."""
    h = np.tanh(x @ p["w"] + p["b"])
    return h, (np.tanh(h @ p["v"]) * sigmoid(h @ p["u"])) @ p["a"]


def loss_and_gradient(
    p: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray, decay: float
) -> tuple[float, dict[str, np.ndarray]]:
    """Weighted log loss over bags; ``first`` has the row at which each bag's passages begin."""
    sizes = np.diff(np.append(first, len(x)))
    bag = np.repeat(np.arange(len(first)), sizes)
    h = np.tanh(x @ p["w"] + p["b"])
    t, s = np.tanh(h @ p["v"]), sigmoid(h @ p["u"])
    e = (t * s) @ p["a"]
    e = np.exp(e - np.maximum.reduceat(e, first)[bag])
    share = e / np.add.reduceat(e, first)[bag]
    z = np.add.reduceat(share[:, None] * h, first)
    out = sigmoid(z @ p["c"] + p["d"])
    loss = -(weight * (y * np.log(out) + (1 - y) * np.log(1 - out))).sum()
    loss += decay / 2 * sum((v**2).sum() for k, v in p.items() if k not in "bd")
    off = weight * (out - y)
    grad = {"c": z.T @ off, "d": np.array([off.sum()])}
    to_z = off[:, None] * p["c"]
    to_share = (h * to_z[bag]).sum(axis=1)
    to_e = share * (to_share - np.add.reduceat(share * to_share, first)[bag])
    grad["a"] = (t * s).T @ to_e
    to_gate = to_e[:, None] * p["a"]
    to_t, to_s = to_gate * s * (1 - t**2), to_gate * t * s * (1 - s)
    grad["v"], grad["u"] = h.T @ to_t, h.T @ to_s
    to_h = share[:, None] * to_z[bag] + to_t @ p["v"].T + to_s @ p["u"].T
    to_h *= 1 - h**2
    grad["w"], grad["b"] = x.T @ to_h, to_h.sum(axis=0)
    for k in grad:
        if k not in "bd":
            grad[k] = grad[k] + decay * p[k]
    return float(loss), grad


def train(
    x: np.ndarray, sizes: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS, decay: float = 1e-4, seed: int = 13
) -> Model:
    """Adam over shuffled groups of 128 bags; ``weight`` has mean 1."""
    mean, spread = x.mean(axis=0, dtype=float), x.std(axis=0, dtype=float) + 1e-2
    x = ((x - mean) / spread).astype(np.float32)
    begin = np.cumsum(sizes) - sizes
    rng = np.random.default_rng(seed)
    p = fresh(rng, x.shape[1])
    m, v = ({k: np.zeros_like(w) for k, w in p.items()} for _ in range(2))
    step = 0
    for turn in range(rounds):
        rate = 3e-3 * (1 - turn / rounds)
        bags = rng.permutation(len(sizes))
        for k in range(0, len(bags), 128):
            some = bags[k : k + 128]
            first = np.cumsum(sizes[some]) - sizes[some]
            rows = np.repeat(begin[some] - first, sizes[some]) + np.arange(int(sizes[some].sum()))
            _, grad = loss_and_gradient(p, x[rows], first, y[some], weight[some] / len(some), decay)
            step += 1
            for key, g in grad.items():
                m[key] = 0.9 * m[key] + 0.1 * g
                v[key] = 0.999 * v[key] + 0.001 * g**2
                p[key] = p[key] - rate * (m[key] / (1 - 0.9**step)) / (np.sqrt(v[key] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, spread, p)


class Scorer:
    """Scores texts with a model; the softmax over passages is carried from stretch to stretch."""

    def __init__(self, model: Model):
        self.model = model

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.model.constant is not None:
            return np.full(len(texts), self.model.constant)
        p = self.model.weights
        top = np.full(len(texts), -np.inf)
        below, above = np.zeros(len(texts)), np.zeros((len(texts), len(p["c"])))
        raws: list[bytes] = []
        owner: list[int] = []
        held = 0

        def add() -> None:
            x, passages = encode(raws)
            h, e = forward(p, (x - self.model.mean) / self.model.spread)
            bag = np.repeat(owner, passages)
            highest = top.copy()
            np.maximum.at(highest, bag, e)
            shrink = np.exp(np.where(np.isinf(top), 0.0, top - np.where(np.isinf(highest), 0.0, highest)))
            weight = np.exp(e - highest[bag])
            below[:] = below * shrink + np.bincount(bag, weight, len(texts))
            above[:] *= shrink[:, None]
            np.add.at(above, bag, weight[:, None] * h)
            top[:] = highest

        for i, text in enumerate(texts):
            for raw in stretches(text):
                raws.append(raw)
                owner.append(i)
                held += len(raw)
                if held >= STRETCH_BYTES:
                    add()
                    raws, owner, held = [], [], 0
        if raws:
            add()
        return sigmoid(above / below[:, None] @ p["c"] + p["d"]) if len(texts) else np.zeros(0)


def may_learn(doc_id: str = "doc_id") -> Column:
    """False for the fifth of ids that is held out."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 != 0


def _passages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Features of a sampled text's passages, in half precision."""
    for batch in batches:
        for quality, text in zip(batch["quality"], batch["text"]):
            parts = [encode([raw])[0] for raw in stretches(text if isinstance(text, str) else None)]
            x = np.concatenate(parts).astype(np.float16)
            if len(x) > SAMPLE_PASSAGES:
                x = x[np.linspace(0, len(x) - 1, SAMPLE_PASSAGES).astype(int)]
            yield pd.DataFrame({"quality": [quality], "passages": [x.tobytes()]})


def fit(docs: DataFrame, labels: DataFrame, sample_texts: int = SAMPLE_TEXTS) -> Model:
    """Learn from labelled documents whose id isn't held out."""
    marks = labels.select("doc_id", "quality").filter(may_learn()).filter("quality IS NOT NULL AND doc_id IS NOT NULL")
    marks = marks.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    name = F.xxhash64(F.coalesce("text", F.lit("")))
    named = docs.select("doc_id", name.alias("name")).join(marks, "doc_id")
    texts = stored(named.groupBy("name", "quality").agg(F.count(F.lit(1)).alias("rows")), "quality-texts")
    counted = {r["quality"]: r for r in texts.groupBy("quality").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("n")).collect()}
    if not (0 in counted and 1 in counted):
        return Model(constant=1.0 if 1 in counted else 0.0)
    draw = F.pmod(F.xxhash64("name", F.lit(13)), F.lit(1 << 30))
    picked = []
    for quality in (0, 1):  # twice as many as needed are expected below the cut, so that little is sorted
        cut = int(min(1.0, 2 * sample_texts / counted[quality]["n"]) * (1 << 30))
        some = texts.filter((F.col("quality") == quality) & (draw < cut)).orderBy(draw, "name").limit(sample_texts)
        picked.append(some.select("name", "quality"))
    chosen = F.broadcast(picked[0].unionByName(picked[1]))  # 2 * sample_texts rows at most
    sample = docs.select("text", name.alias("name")).join(chosen, "name")
    sample = sample.groupBy("name", "quality").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    rows = sample.select("quality", "text").mapInPandas(_passages, "quality int, passages binary")
    rows = stored(rows, "quality-sample").collect()  # sample_texts * SAMPLE_PASSAGES passages of either class at most
    rows.sort(key=lambda r: (r["quality"], bytes(r["passages"])))
    bags = [np.frombuffer(r["passages"], np.float16).reshape(-1, FEATURES) for r in rows]
    y = np.array([r["quality"] for r in rows], float)
    if not 0 < y.sum() < len(y):
        return Model(constant=float(y.any()))
    sampled = np.array([(y == q).sum() for q in (0, 1)])
    weight = np.array([counted[q]["rows"] for q in (0, 1)]) / sampled
    weight = weight[y.astype(int)]
    return train(np.concatenate(bags).astype(np.float32), np.array([len(b) for b in bags]), y, weight / weight.mean())


def _score(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            scores = scorer.score(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return run


def score_table(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_score(fit(docs, labels)), SCORED).select(
        "doc_id",
        F.coalesce(~may_learn(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score at least the threshold, columns unchanged."""
    model = fit(docs, labels)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(Scorer(model).score([t if isinstance(t, str) else None for t in texts]))

    return docs.filter(scored("text") >= threshold)
