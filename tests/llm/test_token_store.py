"""Elias-Fano code, the word encoder, and the round trip through the files."""

import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm.token_store import EliasFano, Shard, WordEncoder, token_index, write_tokens
from tests.llm.data import COLUMNS, awkward, documents

FILE = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(FILE)
ENCODER = WordEncoder(FILE, 2)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=1500), st.data())
def test_elias_fano_returns_every_value(steps, data):
    values = np.cumsum(steps)
    code = EliasFano.build(values)
    first = data.draw(st.integers(0, len(values) - 1))
    count = data.draw(st.integers(0, len(values) - first))
    assert code.get(first, count).tolist() == values[first : first + count].tolist()


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000))
    code = EliasFano.build(values)
    bits = 8 * (len(code.lows) + len(code.highs)) + 32 * len(code.samples)
    assert bits / len(values) < 2.5 + np.log2(values[-1] / len(values))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aAzZéÉßİıſΣςß'’.,!-01½²ªǅ́̇\xa0\x85\x1c\x00\t\n <|>日本😀startofext"), max_size=40) | st.text(max_size=30))
def test_encoder_equals_the_tokenizer(text):
    text = text.encode("utf-8", "replace").decode()
    want = WHOLE.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ENCODER.encode(text), ENCODER.pack).tolist() == want


def test_round_trip(spark):
    rows = awkward()
    got = [tuple(r) for r in token_index(documents(spark, rows), FILE).collect()]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    ids = {t: [*WHOLE.encode(t or "", add_special_tokens=False).ids, 2] for _, t, _ in rows}
    want, start = [], 0
    for doc_id, text, _ in order:
        packed = np.array(ids[text], "<u4").tobytes()
        want.append((doc_id, start, len(ids[text]), zlib.crc32(packed)))
        start += len(ids[text])
    key = lambda r: r[1]
    assert sorted(got, key=key) == want


def test_random_access(spark):
    rows = [(k, f"word{k} and more") for k in range(50)]
    found = {}
    for _, path, docs, _ in write_tokens(documents(spark, rows), FILE):
        shard = Shard(path)
        for k in range(docs):
            begin, end = shard.bounds(k, 1).tolist()
            found[shard.doc_ids(k, 1)[0]] = shard.ids(begin, end).tolist()
    assert found == {k: [*WHOLE.encode(t, add_special_tokens=False).ids, 2] for k, t in rows}


def test_empty_table(spark):
    assert token_index(spark.createDataFrame([], COLUMNS), FILE).collect() == []
