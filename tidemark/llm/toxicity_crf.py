"""Toxicity: a linear-chain conditional random field tags toxic words, documents sum them up.

Only documents carry labels, so words are labelled first: a word is toxic where it stands in a toxic
document and, over the sampled labelled documents, it occurs in many toxic and next to no clean ones
and among ever new neighbours. Sampled documents of one class with the same words count as one, in all
that is learned. Where no word qualifies, each word's odds in toxic against clean texts take the place
of the chain, so that scores still follow the text. Otherwise a chain with two tags
is then trained on windows of labelled words by its exact likelihood; features are the word and its
beginnings of four to six letters. Forward-backward marginals give the probability that a word is
offending; a logistic curve over the largest marginal and the expected number of offending words,
fitted to the documents' labels, gives the score.

Inputs of a score are words only. Learning uses at most ``SAMPLE_DOCS`` labelled documents of either
class and ``WINDOWS`` windows of either kind, picked by hash; class frequencies are counted over all
labelled rows, copies included, and spread evenly over a class's sampled texts. Scoring streams every whole text; memory is bounded by one batch.

Defined cases: null and empty texts score like texts without words; null labels and labels without a
document are left out, and a null id isn't held out; a document labelled more than once counts as
toxic if any label says so; with no labels of one class every score is the share of toxic labels (0
with no labels at all).
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

SAMPLE_DOCS = 3_000
WINDOWS = 3_000
WINDOW_WORDS = 48
THRESHOLD = 0.3
CHUNK_WORDS = 1 << 19
CACHE_WORDS = 400_000
STEP = 128
#: Lengths of a word's beginnings that are features of their own.
BEGINNINGS = (4, 5, 6)

TOKEN = re.compile(r"[^\W_]+")


@dataclass
class Model:
    """Chain weights (tag 1 against tag 0), transitions, and the curve over documents."""

    weights: dict[str, float]
    bias: float
    start: np.ndarray  # of the two tags, summing to 1
    trans: np.ndarray  # rows: from tag, summing to 1 up to a factor
    curve: np.ndarray  # intercept, largest marginal, log(1 + expected words)
    constant: float | None = None


def words_of(text: str) -> list[str]:
    """Words in lower case, one for each in the text itself: the dotted capital I alone grows in lower case."""
    if "\u0130" in text:
        return [word.lower() for word in TOKEN.findall(text)]
    return TOKEN.findall(text.lower())


def features(word: str) -> tuple[str, ...]:
    """The word and its beginnings; inflected forms share those."""
    return word, *("^" + word[:n] if len(word) > n else "" for n in BEGINNINGS)


def marginals(emit: np.ndarray, first: np.ndarray, model: Model) -> np.ndarray:
    """P(tag 1) of every word of many chains laid end to end; ``first`` marks where a chain starts.

    A step is a 2x2 matrix (from tag, to tag); at a chain's first word its rows are equal, which
    forgets what came before. The words are cut in pieces of ``STEP``, the products of the pieces'
    matrices link them, and so all pieces advance at once, each in its column.
    """
    n = len(emit)
    pieces = -(-n // STEP)
    odds = np.ones(pieces * STEP)
    odds[:n] = np.exp(np.clip(emit, -30, 30))
    begins = np.ones(pieces * STEP, bool)  # what follows the last word is chains of their own
    begins[:n] = first
    odds, begins = (np.ascontiguousarray(x.reshape(pieces, STEP).T) for x in (odds, begins))
    (t00, t01), (t10, t11) = model.trans
    s0, s1 = model.start
    m00, m10 = np.where(begins, s0, t00), np.where(begins, s0, t10)
    m01, m11 = np.where(begins, s1, t01) * odds, np.where(begins, s1, t11) * odds
    p00, p01, p10, p11 = m00[0], m01[0], m10[0], m11[0]
    for t in range(1, STEP):
        p00, p01, p10, p11 = (
            p00 * m00[t] + p01 * m10[t],
            p00 * m01[t] + p01 * m11[t],
            p10 * m00[t] + p11 * m10[t],
            p10 * m01[t] + p11 * m11[t],
        )
        scale = 1 / (p00 + p01 + p10 + p11)
        p00, p01, p10, p11 = p00 * scale, p01 * scale, p10 * scale, p11 * scale
    # a state is kept as the share of tag 1 (forward), or of the weight of tag 1 (backward)
    enter, leave = np.empty(pieces), np.empty(pieces)
    columns = list(zip(p00.tolist(), p01.tolist(), p10.tolist(), p11.tolist()))
    share = 0.5
    for k, (q00, q01, q10, q11) in enumerate(columns):
        enter[k] = share
        low, high = (1 - share) * q00 + share * q10, (1 - share) * q01 + share * q11
        share = high / (low + high)
    share = 0.5
    for k in range(pieces - 1, -1, -1):
        leave[k] = share
        q00, q01, q10, q11 = columns[k]
        low, high = q00 * (1 - share) + q01 * share, q10 * (1 - share) + q11 * share
        share = high / (low + high)
    forward = np.empty((STEP, pieces))
    share = enter
    for t in range(STEP):
        rest = 1 - share
        high = rest * m01[t] + share * m11[t]
        share = high / (rest * m00[t] + share * m10[t] + high)
        forward[t] = share
    share = leave
    for t in range(STEP - 1, -1, -1):
        ahead = forward[t]
        rest = 1 - share
        forward[t] = ahead * share / (ahead * share + (1 - ahead) * rest)
        high = m10[t] * rest + m11[t] * share
        share = high / (m00[t] * rest + m01[t] * share + high)
    return forward.T.reshape(-1)[:n]


def train_chain(
    windows: list[list[str]], tags: list[list[int]], rounds: int = 80, decay: float = 1e-3
) -> tuple[dict[str, float], float, np.ndarray, np.ndarray]:
    """Adam on the penalised likelihood over all windows at once; padding has no evidence."""
    index: dict[str, int] = {}
    width = max(map(len, windows))
    n = len(windows)
    ids = np.zeros((n, width, 1 + len(BEGINNINGS)), np.int64)
    gold = np.zeros((n, width), np.int64)
    real = np.zeros((n, width), bool)
    for i, (words, marks) in enumerate(zip(windows, tags)):
        for t, word in enumerate(words):
            ids[i, t] = [index.setdefault(f, len(index)) for f in features(word)]
        gold[i, : len(marks)] = marks
        real[i, : len(words)] = True
    size = len(index)
    theta = np.zeros(size + 1 + 2 + 4)  # words, bias, start, transitions
    theta[size] = -2.0
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    both_real = real[:, 1:]
    gold_pairs = [((gold[:, :-1] * 2 + gold[:, 1:] == k) & both_real).sum() for k in range(4)]
    flat, words = ids.reshape(-1), real.sum()
    for step in range(1, rounds + 1):
        odds = np.where(real, np.exp(np.clip(theta[ids].sum(axis=2) + theta[size], -30, 30)), 1.0)
        start = np.exp(theta[size + 1 : size + 3])
        trans = np.exp(theta[size + 3 :].reshape(2, 2))
        low, high = np.empty((n, width)), np.empty((n, width))  # forward weights, scaled to sum 1
        for t in range(width):
            if t:
                a = low[:, t - 1] * trans[0, 0] + high[:, t - 1] * trans[1, 0]
                b = (low[:, t - 1] * trans[0, 1] + high[:, t - 1] * trans[1, 1]) * odds[:, t]
                a, b = np.where(real[:, t], a, low[:, t - 1]), np.where(real[:, t], b, high[:, t - 1])
            else:
                a, b = np.full(n, start[0]), start[1] * odds[:, 0]
            low[:, t], high[:, t] = a / (a + b), b / (a + b)
        back0, back1 = np.ones(n), np.ones(n)
        share = np.empty((n, width))
        pair_sums = np.zeros(4)
        for t in range(width - 1, -1, -1):
            x, y = low[:, t] * back0, high[:, t] * back1
            share[:, t] = y / (x + y)
            if t:
                z0, z1 = back0, odds[:, t] * back1
                paths = [
                    low[:, t - 1] * trans[0, 0] * z0,
                    low[:, t - 1] * trans[0, 1] * z1,
                    high[:, t - 1] * trans[1, 0] * z0,
                    high[:, t - 1] * trans[1, 1] * z1,
                ]
                scale = real[:, t] / sum(paths)
                pair_sums += [(q * scale).sum() for q in paths]
                a, b = trans[0, 0] * z0 + trans[0, 1] * z1, trans[1, 0] * z0 + trans[1, 1] * z1
                a, b = np.where(real[:, t], a, back0), np.where(real[:, t], b, back1)
                back0, back1 = a / (a + b), b / (a + b)
        off = np.where(real, share - gold, 0.0)
        grad = np.zeros_like(theta)
        grad[:size] = np.bincount(flat, np.repeat(off.reshape(-1), ids.shape[2]), size)
        grad[size] = off.sum()
        grad[size + 2] = (share[:, 0] - gold[:, 0]).sum()
        grad[size + 1] = -grad[size + 2]
        grad[size + 3 :] = pair_sums - gold_pairs
        grad = grad / words + decay * 0.01 * theta
        mean = 0.9 * mean + 0.1 * grad
        square = 0.999 * square + 0.001 * grad**2
        theta -= 0.2 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    weights = {f: float(theta[i]) for f, i in index.items() if abs(theta[i]) > 0.05}
    start = np.exp(theta[size + 1 : size + 3])
    trans = np.exp(theta[size + 3 :].reshape(2, 2))
    return weights, float(theta[size]), start / start.sum(), trans


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) / weight.sum() + 1e-3 * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x / weight.sum() + 1e-3 * np.eye(len(w))
        w -= np.linalg.solve(curve, grad)
    return w


class Emissions(dict):
    """A word's evidence for tag 1, worked out when first asked for."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        weights = self.model.weights
        value = self[word] = self.model.bias + sum(weights.get(f, 0.0) for f in features(word))
        return value


def _document_marginals(
    texts: list[str], model: Model, emissions: Emissions
) -> Iterator[tuple[int, np.ndarray]]:
    """(number of the text, marginals of its words), a bounded number of words at a time."""

    def flush() -> Iterator[tuple[int, np.ndarray]]:
        ends = np.cumsum([len(words) for _, words in held])
        flat = [w for _, words in held for w in words]
        if not flat:
            yield from ((i, np.zeros(0)) for i, _ in held)
            return
        if len(emissions) > CACHE_WORDS:
            emissions.clear()
        emit = np.fromiter(map(emissions.__getitem__, flat), float, len(flat))
        first = np.zeros(len(flat), bool)
        first[[0, *(e for e in ends[:-1] if e < len(flat))]] = True
        shares = np.split(marginals(emit, first, model), ends[:-1])
        yield from ((i, s) for (i, _), s in zip(held, shares))

    held: list[tuple[int, list[str]]] = []
    words_held = 0
    for i, text in enumerate(texts):
        words = words_of(text) if text else []
        held.append((i, words))
        words_held += len(words)
        if words_held >= CHUNK_WORDS:
            yield from flush()
            held, words_held = [], 0
    if held:
        yield from flush()


def _summary(shares: np.ndarray) -> tuple[float, float]:
    if not len(shares):
        return 0.0, 0.0
    sure = shares[shares > 0.05]  # words that are almost surely harmless don't add up
    return float(shares.max()), float(math.log1p(sure.sum()))


def spans_of(text: str, shares: np.ndarray, least: float = 0.5) -> list[dict]:
    """Character offsets of runs of words with a marginal of at least ``least``."""
    spans: list[dict] = []
    if not len(shares) or shares.max() < least:
        return spans
    last = -2
    for k, match in enumerate(TOKEN.finditer(text)):
        if shares[k] >= least:
            if last == k - 1:
                spans[-1]["end"] = match.end()
                spans[-1]["probability"] = max(spans[-1]["probability"], float(shares[k]))
            else:
                spans.append({"start": match.start(), "end": match.end(), "probability": float(shares[k])})
            last = k
    return spans


def _score(top: float, words: float, model: Model) -> float:
    if model.constant is not None:
        return model.constant
    z = float(model.curve @ np.array([1.0, top, words]))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def scorer(model: Model) -> Callable[[Column], Column]:
    """Column function: text -> struct(score, spans)."""

    @F.pandas_udf("score double, spans array<struct<start:int,end:int,probability:double>>")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        emissions = Emissions(model)
        for texts in batches:
            texts = [t if isinstance(t, str) else "" for t in texts]
            scores, spans = [0.0] * len(texts), [None] * len(texts)
            for i, shares in _document_marginals(texts, model, emissions):
                scores[i] = _score(*_summary(shares), model)
                spans[i] = spans_of(texts[i], shares)
            yield pd.DataFrame({"score": scores, "spans": spans})

    return scored


def may_learn(doc_id: str = "doc_id") -> Column:
    """False for the quarter of ids that is held out."""
    return F.crc32(F.col(doc_id).cast("string")) % 4 != 2


def _sample(rows: DataFrame, counted: dict[int, int]) -> DataFrame:
    """At most ``SAMPLE_DOCS`` of either class, those with the smallest hashes.

    Twice as many are expected below the first cut, so that no task sorts more than that.
    """
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    parts = []
    for y in (0, 1):
        cut = int(min(1.0, 2 * SAMPLE_DOCS / max(1, counted.get(y, 0))) * (1 << 30))
        picked = rows.filter((F.col("toxic") == y) & (draw < cut))
        parts.append(picked.orderBy(draw, "doc_id").limit(SAMPLE_DOCS))
    return parts[0].unionByName(parts[1])


def _word_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each document's distinct (unit, neighbours), the unit's first row marked."""
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"]):
            words = words_of(text) if isinstance(text, str) else []
            seen: dict[str, set[int]] = {}
            for before, word, after in zip(["", *words], words, [*words[1:], ""]):
                around = hash_of(before + " " + after)
                for unit in features(word):
                    if unit:
                        seen.setdefault(unit, set()).add(around)
            if seen:
                sizes = [len(v) for v in seen.values()]
                first = np.zeros(sum(sizes), np.int32)
                first[np.cumsum([0, *sizes[:-1]])] = 1
                yield pd.DataFrame(
                    {
                        "word": np.repeat(list(seen), sizes),
                        "around": [a for v in seen.values() for a in v],
                        "toxic": int(toxic),
                        "first": first,
                    }
                )


def hash_of(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text) >> 1


def _name(texts: pd.Series) -> pd.Series:
    """Equal for texts with the same words."""
    return pd.Series([hash_of(" ".join(words_of(t))) if isinstance(t, str) else 0 for t in texts])


def distinct_texts(rows: DataFrame) -> DataFrame:
    """text, toxic: one row for all rows of a class whose texts have the same words."""
    named = rows.select("text", "toxic", F.pandas_udf(_name, "long")("text").alias("name"))
    return named.groupBy("name", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")


def _units(sample: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Texts of either class with a word or beginning, its places in toxic ones; texts by class."""
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    units = (
        sample.select("text", "toxic")
        .mapInPandas(_word_rows, "word string, around long, toxic int, first int")
        .groupBy("word")
        .agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("first"))).alias("bad"),
            F.sum(F.when(F.col("toxic") == 0, F.col("first"))).alias("good"),
            F.count_distinct(F.when(F.col("toxic") == 1, F.col("around"))).alias("places"),
        )
        .na.fill(0)
    )
    return units, n


def toxic_words(sample: DataFrame, limit: int = 2_000) -> set[str]:
    """Words and beginnings that mark toxic documents; at most ``limit``, the best supported first."""
    units, n = _units(sample)
    bad, good = F.col("bad") / n.get(1, 1), F.col("good") / n.get(0, 1)
    found = units.filter((F.col("bad") >= 3) & (bad > 10 * good) & (F.col("places") >= 0.6 * F.col("bad")))
    return {r["word"] for r in found.orderBy(F.desc("bad"), "word").limit(limit).collect()}


def word_odds(sample: DataFrame, limit: int = 20_000) -> dict[str, float]:
    """Log odds of the words that speak for a toxic text; at most ``limit``, the strongest first."""
    units, n = _units(sample)
    bad, good = (F.col("bad") + 0.5) / (n.get(1, 0) + 1), (F.col("good") + 0.5) / (n.get(0, 0) + 1)
    found = units.filter(~F.col("word").startswith("^")).select("word", F.log(bad / good).alias("odds"))
    return {r["word"]: r["odds"] for r in found.filter("odds > 0").orderBy(F.desc("odds"), "word").limit(limit).collect()}


def _windows(lexicon: set[str]) -> Callable:
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, toxic in zip(batch["text"], batch["toxic"]):
                words = words_of(text) if isinstance(text, str) else []
                for k in range(0, len(words), WINDOW_WORDS):
                    part = words[k : k + WINDOW_WORDS]
                    marks = [int(toxic == 1 and not lexicon.isdisjoint(features(w))) for w in part]
                    if toxic == 0 or any(marks):
                        rows.append((part, marks, int(any(marks)), hash_of(" ".join(part))))
            yield pd.DataFrame(rows, columns=["words", "tags", "marked", "draw"])

    return cut


def _chain(sample: DataFrame, lexicon: set[str]) -> tuple[dict[str, float], float, np.ndarray, np.ndarray]:
    """The chain's weights, bias, start and transitions."""
    cut = sample.select("text", "toxic").mapInPandas(
        _windows(lexicon), "words array<string>, tags array<int>, marked int, draw long"
    )
    # a mark at either end of a tie is the same window, so which of equal windows is kept is no matter
    picked = [
        r
        for kind in (1, 0)
        for r in cut.filter(F.col("marked") == kind).orderBy("draw").limit(WINDOWS).collect()
    ]
    return train_chain([r["words"] for r in picked], [r["tags"] for r in picked])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from labelled documents whose id isn't held out."""
    none = Model({}, 0.0, np.array([0.5, 0.5]), np.full((2, 2), 0.5), np.zeros(3))
    marks = labels.filter(may_learn()).filter("toxic IS NOT NULL AND doc_id IS NOT NULL")
    counted = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    ids = _sample(marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), counted)
    sample = stored(distinct_texts(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")), "tox-sample")
    classes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not classes.get(1) or not classes.get(0):
        none.constant = counted.get(1, 0) / max(1, sum(counted.values()))
        return none
    lexicon = toxic_words(sample)
    if lexicon:
        model = Model(*_chain(sample, lexicon), np.zeros(3))
    else:  # words on their own; one without odds stays below what a summary adds up
        model = Model(word_odds(sample), -3.0, none.start, none.trans, np.zeros(3))

    @F.pandas_udf("top double, words double")
    def summed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        emissions = Emissions(model)
        for texts in batches:
            texts = [t if isinstance(t, str) else "" for t in texts]
            out = [(0.0, 0.0)] * len(texts)
            for i, shares in _document_marginals(texts, model, emissions):
                out[i] = _summary(shares)
            yield pd.DataFrame(out, columns=["top", "words"])

    seen = sample.select("toxic", summed("text").alias("s")).select("toxic", "s.*").toPandas()
    y = seen["toxic"].to_numpy(float)
    weight = np.where(y == 1, counted.get(1, 1) / classes[1], counted.get(0, 1) / classes[0])
    model.curve = fit_curve(seen[["top", "words"]].to_numpy(float), y, weight)
    return model


def score_table(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted and offending spans of every document."""
    scored = scorer(fit(docs, labels))
    return docs.select("doc_id", scored("text").alias("s")).select(
        "doc_id",
        F.coalesce(~may_learn(), F.lit(False)).alias("held_out"),
        F.col("s.score").alias("score"),
        (F.col("s.score") >= threshold).cast("int").alias("predicted"),
        F.col("s.spans").alias("spans"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below the threshold, columns unchanged."""
    scored = scorer(fit(docs, labels))
    return docs.filter(scored("text")["score"] < threshold)
