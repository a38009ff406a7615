"""k-d sharding and source mixing."""

import zlib
from collections import defaultdict

import pytest

from tidemark.llm import kd_sharding, mixing
from tests.llm.data import COLUMNS, awkward, documents


def test_shards_are_near_equal_whole_and_numbered(spark):
    rows = awkward(n=400)
    got = kd_sharding.shard_table(documents(spark, rows), 6).collect()
    assert len(got) == len(rows)
    crc = lambda t: None if t is None else zlib.crc32(t.encode())
    size = lambda t: len((t or "").encode()) + 16
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=key) == sorted(
        ((i, size(t), crc(t)) for i, t, _ in rows), key=key
    )
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(size(t) for _, t, _ in rows)
    mean = sum(sizes.values()) / 6
    assert all(abs(s - mean) <= largest for s in sizes.values())


def test_equal_metadata_is_split_too(spark):
    """All dimensions agree, so only the hash tells rows apart."""
    rows = spark.range(600).selectExpr("id AS doc_id", "'tie' AS text", "1 AS n_chars", "'en' AS lang", "'s' AS source")
    got = kd_sharding.shard_table(rows, 5, ("n_chars", "lang", "source")).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in got) == [120] * 5


def test_rows_and_columns_pass_through(spark):
    docs = documents(spark, awkward())
    placed = kd_sharding.add_shards(docs, 4)
    assert sorted(placed.columns) == sorted(docs.columns)
    assert placed.count() == docs.count()
    assert {r.shard for r in placed.select("shard").collect()} <= set(range(4))
    by_row = {(r.doc_id, r.text): r.shard for r in placed.collect()}
    again = kd_sharding.add_shards(docs.repartition(3), 4).collect()
    assert {(r.doc_id, r.text): r.shard for r in again} == by_row


def test_written_shards(spark, tmp_path):
    docs = documents(spark, awkward())
    kd_sharding.write_shards(docs, str(tmp_path / "out"), 4)
    assert spark.read.parquet(str(tmp_path / "out")).count() == docs.count()


def test_leaves_for_a_target_size(spark):
    docs = documents(spark, [(k, "x" * 84) for k in range(10)])
    assert kd_sharding.leaves_for(docs, 250) == 4


def test_empty_tables(spark):
    docs = spark.createDataFrame([], COLUMNS)
    assert kd_sharding.shard_table(docs, 40).collect() == []
    assert kd_sharding.add_shards(docs, 40).collect() == []
    assert mixing.mixture(docs).collect() == []
    assert mixing.mix(docs).collect() == []


def shares(sizes, weights):
    """Water filling, one round after another."""
    total, capped = sum(sizes), set()
    while True:
        open_ = [k for k in range(len(sizes)) if k not in capped]
        pool = total - sum(3 * sizes[k] for k in capped)
        weight = sum(weights[k] for k in open_)
        target = {k: pool * weights[k] / weight for k in open_} if weight else {}
        over = {k for k in open_ if target[k] > 3 * sizes[k]}
        if not over:
            return [3 * sizes[k] if k in capped else target[k] for k in range(len(sizes))]
        capped |= over


@pytest.mark.parametrize("sizes", [[5, 500, 400], [100, 1, 1, 1, 1000], [3, 3, 3, 3, 3, 3, 90], [0, 10, 10], [7]])
def test_targets_fill_up_in_rounds(spark, sizes):
    rows = [(f"s{k}" if k < len(sizes) - 1 else None, n) for k, n in enumerate(sizes)]
    got = mixing.targets(spark.createDataFrame(rows, "source string, source_size long")).collect()
    want = shares(sizes, [(5, 2, 1)[k % 3] for k in range(len(sizes))])
    found = {r.source: r.target for r in got}
    assert [found[s] for s, _ in rows] == pytest.approx(want)


def test_mix_comes_near_its_targets(spark):
    rows = awkward(n=600)
    docs = documents(spark, rows)
    plan = mixing.mixture(docs).collect()
    assert len(plan) == len(rows)
    assert all(r.taken <= 3 * r.size for r in plan)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    words = sum(len((r.text or "").split()) for r in mixed.collect())
    assert words == sum(r.taken for r in plan)
    targets = {(r.source_size, r.target) for r in plan}
    assert words == pytest.approx(sum(t for _, t in targets), rel=0.15)


def test_mix_repeats_itself(spark):
    docs = documents(spark, awkward())
    key = lambda r: str(tuple(r))
    assert sorted(mixing.mix(docs).collect(), key=key) == sorted(mixing.mix(docs.repartition(5)).collect(), key=key)
