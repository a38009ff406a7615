"""What one task holds, and what goes to the driver, stays bounded as tables grow."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators.distinct import RANGE, distinct_counts, distinct_sets, merged_sets
from tidemark.operators.skew import full_slots, hot_keys, hot_within
from tidemark.plans.pipeline import Run
from tidemark.session import tune
from tidemark.sources import tables
from tidemark.sources.csv import LINES, STITCHED, WHOLE, layout
from workload import registry
from workload.registry import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def below_exchanges(df, what):
    """Whether an operator that names ``what`` feeds an exchange, by the indents of the plan."""
    depth = lambda line: len(re.match(r"[ :+|*()0-9-]*", line).group())
    lines = plan(df).splitlines()
    for k, line in enumerate(lines):
        if "Exchange" in line:
            for other in lines[k + 1 :]:
                if depth(other) <= depth(line):
                    break
                if what in other:
                    return True
    return False


@pytest.mark.parametrize("rows, least", [(3_600_000, 4), (36_000_000, 36), (216_000_000, 216)])
def test_a_bucket_stays_small_as_orders_grow(spark, tmp_path, rows, least):
    run = Run(spark, str(tmp_path))
    run.rows["bronze.order_items"] = rows
    assert run.buckets >= least
    assert Run(spark, str(tmp_path), buckets=3).buckets == 3


def test_numbers_are_moved_and_not_bitmaps(spark):
    rows = spark.range(0, 200_000, 1, 16).selectExpr("cast(id % 7 AS int) AS mes", "'c' || id % 50 AS c", "id div 3 AS numero")
    rows = rows.unionByName(rows.limit(1000)).unionByName(spark.sql("SELECT 1 AS mes, 'c1' AS c, cast(NULL AS bigint) AS numero"))
    sets = distinct_sets(rows, "mes", "c")
    assert not below_exchanges(sets, "bitmap_construct_agg")
    sets.count()
    want = {tuple(r) for r in rows.filter("numero IS NOT NULL").groupBy("c").agg(F.count_distinct("numero")).collect()}
    assert {tuple(r) for r in distinct_counts(sets, "c").collect()} == want
    assert sets.groupBy("mes", "c", RANGE).count().filter("count > 1").isEmpty()


def test_bitmaps_are_merged_in_as_many_tasks_as_asked_for(spark):
    """They shrink so much in a shuffle that tasks sized there would hold all of them."""
    rows = spark.range(40_000).selectExpr("cast(id % 12 AS int) AS mes", "'c' || id % 40 AS c", "id AS numero")
    merged = merged_sets(distinct_sets(rows, "mes", "c"), "c")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        merged = merged_sets(distinct_sets(rows, "mes", "c"), "c")
        assert not below_exchanges(merged, "bitmap_or_agg")
        assert merged.select(F.spark_partition_id().alias("p")).distinct().count() > 20
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_looking_for_hot_keys_sends_no_summaries_to_the_driver(spark, tmp_path, monkeypatch):
    seen = []
    real = tables.observed

    def watching(df, expectations=(), more=None):
        seen.append(str(list((more or {}).values())))
        return real(df, expectations, more)

    monkeypatch.setattr(tables, "observed", watching)
    rows = spark.range(0, 30_000, 1, 12).selectExpr("if(id % 4 = 0, 'h' || id % 3, if(id % 7 = 0, NULL, cast(id AS string))) AS k")
    found, hot = tables.write_finding_hot(rows, str(tmp_path / "t"), "k", 100, more={"n": F.count("k")})
    assert seen and not any("approx_top_k" in s for s in seen)
    assert found == {"_rows": 30_000, "n": rows.filter("k IS NOT NULL").count()}
    assert {tuple(r) for r in hot.collect()} == {("h0", 2500), ("h1", 2500), ("h2", 2500)}


def test_no_hot_key_is_missed_whatever_shares_its_slot(spark):
    rows = spark.range(50_000).selectExpr("cast(id % 3000 AS string) AS k").unionByName(
        spark.range(900).selectExpr("if(id % 3 = 0, NULL, 'x') AS k")
    )
    for slots in (1, 16, 1 << 16):
        assert full_slots(rows, "k", 500, slots).count() >= 1
    got = hot_within(rows, "k", full_slots(rows, "k", 500), 500)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, hot_keys(rows, "k", 500).collect())) == [("x", 600)]


@pytest.mark.parametrize(
    "text, mode",
    [
        ("a,b\n1,2\n3,4\n", LINES),
        ("a,b\r\n1,2\r\n3,\r\n", LINES),
        ('a,b\n"1,""x""",2\n3,4\n', LINES),
        ('a,b\n"1\n5",2\n3,4\n', STITCHED),
        ('a,b\n1"x,2\n3,4\n', WHOLE),
        ("a,b\n1\rx,2\n3,4\n", WHOLE),
        ("a,b\n1,2\r\n3,4\n", WHOLE),
        ('a,b\r\n"1\r\n5",2\r\n3,4\r\n', WHOLE),
    ],
)
def test_lines_without_quotes_need_no_proof(spark, tmp_path, text, mode):
    (tmp_path / "f.csv").write_bytes(text.encode())
    assert layout(spark, str(tmp_path / "f.csv")) == mode


def test_big_drops_are_read_in_parts(spark, sf_dir, monkeypatch):
    """A drop whose lines are records isn't read by one task per file."""
    modes = []
    real = registry.ingest_all_string

    def watching(spark, path, schema=None, mode=WHOLE):
        modes.append(mode)
        return real(spark, path, schema, mode)

    monkeypatch.setattr(registry, "ingest_all_string", watching)
    rows = QUERIES["bronze_contents"](spark, sf_dir).collect()
    assert modes == [LINES] * 9
    assert len(rows) == 9 and all(r["conta_bate"] and r["conteudo_bate"] for r in rows)


def test_a_task_takes_few_megabytes_of_a_shuffle(spark):
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert tune(spark).conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8m"
