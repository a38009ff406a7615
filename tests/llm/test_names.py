"""Names: the caller's columns may have any, and sets of one 64-bit name are told apart."""

import random
import re
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.llm.data import documents, words
from tidemark.llm import (
    decontamination,
    importance_resampling,
    jaccard_tiles,
    kd_sharding,
    mixing,
    quality_attention,
    toxicity_crf,
)

SOURCES = Path(jaccard_tiles.__file__).parent
#: Every name that begins with an underscore in quotes anywhere in the package, and plain ones that are used inside.
INTERNAL = sorted(
    {n for f in SOURCES.glob("*.py") for n in re.findall(r'"(_[a-z]+_?[a-z]*)"', f.read_text())}
    | set("row copies copy leaf i m vid proof tile sig comp main rank shift draw size taken off at part bucket name".split())
)


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    rows = [(k, " ".join(words(rng, 40)), "en", f"s{k % 3}", 40) for k in range(60)] + [(100, None, None, None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return table.select("*", *(F.concat(F.lit(f"{n}:"), F.col("doc_id")).alias(n) for n in INTERNAL))


def labels(spark, column):
    return spark.createDataFrame([(k, int(k % 2)) for k in range(60)], f"doc_id long, {column} int")


@pytest.mark.parametrize("name", ["mix", "add_shards", "drop_toxic", "keep_one", "drop_contaminated", "resample", "keep_good"])
def test_columns_come_back(spark, docs, name):
    benchmark = spark.createDataFrame([(1, "no such text anywhere in these documents at all")], "item_id long, text string")
    result = {
        "mix": lambda: mixing.mix(docs),
        "add_shards": lambda: kd_sharding.add_shards(docs, 4),
        "drop_toxic": lambda: toxicity_crf.drop_toxic(docs, labels(spark, "toxic")),
        "keep_one": lambda: jaccard_tiles.keep_one(docs),
        "drop_contaminated": lambda: decontamination.drop_contaminated(docs, benchmark),
        "resample": lambda: importance_resampling.resample(docs, benchmark, least_words=1),
        "keep_good": lambda: quality_attention.keep_good(docs, labels(spark, "quality")),
    }[name]()
    assert [c for c in result.columns if c != "shard"] == docs.columns
    rows = result.collect()
    assert rows
    for r in rows:
        assert all(r[n] == (None if r["doc_id"] is None else f"{n}:{r['doc_id']}") for n in INTERNAL)


def test_sets_of_one_name_are_told_apart(spark, monkeypatch):
    """With names of sixteen bits many sets share one; components are those of the full names."""
    rng = random.Random(7)
    rows = []
    for k in range(700):
        text = words(rng, 60, 5000)
        rows.append((10 * k, " ".join(text), "s"))
        if k % 3 == 0:
            rows.append((10 * k + 1, " ".join(text[:59] + ["other"]), "s"))
        if k % 5 == 0:
            rows.append((10 * k + 2, " ".join(text), "s"))
    table = documents(spark, rows)
    want = sorted(map(tuple, jaccard_tiles.component_table(table).collect()))
    monkeypatch.setattr(jaccard_tiles, "NAME_BITS", 16)
    sets = jaccard_tiles.document_sets(table).select("vid", "proof").distinct().collect()
    by_name = defaultdict(set)
    for r in sets:
        by_name[r["vid"]].add(r["proof"])
    assert all(len(p) == 1 for p in by_name.values()) and any(abs(v) >= 1 << 15 for v in by_name)
    assert sorted(map(tuple, jaccard_tiles.component_table(table).collect())) == want
    assert len({c for *_, c in want}) == 700
