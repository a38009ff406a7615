"""Edge cases the provided tables do not contain."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import int_or_null, money, place_name, timestamp_or_null, zip_prefix
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.expectations import (
    Expectation,
    ExpectationError,
    enforce,
    parseable,
    unparseable,
    violations,
)
from tidemark.operators.quality import (
    QualityGateError,
    gate_result,
    quality_gate,
    quality_report,
    reconcile_sum,
    unique_key,
    volume_check,
)
from tidemark.operators.skew import hot_keys, spread_join
from tidemark.operators.spine import calendar_spine
from tidemark.plans.silver import clean_products


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def strings(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_zip_prefix(spark):
    df = strings(spark, [" 01-310 ", "123", "123456", "abc", None])
    assert one(df, zip_prefix("v")) == ["01310", "00123", "12345", "00000", None]


def test_place_name(spark):
    assert one(strings(spark, [" SAO PAULO-sp "]), place_name("v")) == ["Sao Paulo-sp"]


def test_timestamps(spark):
    df = strings(spark, ["", "garbage", "2017-02-30 00:00:00", "2017-10-02"])
    want = [None, None, None, datetime.datetime(2017, 10, 2)]
    assert one(df, timestamp_or_null("v")) == want


def test_integers(spark):
    assert one(strings(spark, ["12", " 12 ", "12.0", ""]), int_or_null("v")) == [12, 12, None, None]


def test_money_is_strict(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        strings(spark, ["1.00", "x"]).select(money("v")).collect()


def test_quarantine_splits_without_loss(spark):
    df = strings(spark, ["1.00", "x", None])
    assert one(unparseable(df, "v", "decimal(18,2)"), "v") == ["x"]
    assert one(parseable(df, "v", "decimal(18,2)"), "v") == ["1.00", None]


def test_untranslated_category_keeps_its_name(spark):
    columns = (
        "product_id string, product_category_name string, product_name_lenght string, "
        "product_description_lenght string, product_photos_qty string, product_weight_g string, "
        "product_length_cm string, product_height_cm string, product_width_cm string"
    )
    numbers = ("1",) * 7
    raw = spark.createDataFrame(
        [("a", "x", *numbers), ("b", "y", *numbers), ("c", None, *numbers)], columns
    )
    translation = spark.createDataFrame(
        [("x", "ex")], "product_category_name string, product_category_name_english string"
    )
    got = {r["product_id"]: r["categoria_en"] for r in clean_products(raw, translation).collect()}
    assert got == {"a": "ex", "b": "y", "c": None}


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", 5, 2), ("b", 7, 3), ("b", 7, 4), ("c", None, 5)],
        "k string, t int, v int",
    )
    kept = latest_per_key(df, ["k"], "t", ["v"]).collect()
    assert sorted((r["k"], r["v"]) for r in kept) == [("a", 2), ("b", 4), ("c", 5)]


def test_latest_per_key_drops_rows_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 k", "id t")
    plan = latest_per_key(df, ["k"], "t", ["t"])._jdf.queryExecution().toString()
    assert plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")


def test_calendar(spark):
    df = spark.createDataFrame([("2017-01-30 23:59:00",), ("2017-02-02 00:01:00",)], "t string")
    days = calendar_spine(df.select(F.col("t").cast("timestamp")), "t").collect()
    assert [str(d["data"]) for d in days] == ["2017-01-30", "2017-01-31", "2017-02-01", "2017-02-02"]
    assert [d["dia_semana"] for d in days][0] == "Monday"
    assert calendar_spine(df.select(F.col("t").cast("timestamp")).limit(0), "t").count() == 0


# Skew ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 7 holds a third of the rows, all copies of one row; NULL keys hold some, too."""
    hot = spark.range(3000).select(F.lit(7).alias("k"), F.lit(0).cast("long").alias("v"))
    cold = spark.range(6000).select((F.col("id") % 2000 + 100).cast("int").alias("k"), F.col("id").alias("v"))
    null = spark.range(50).select(F.lit(None).cast("int").alias("k"), F.col("id").alias("v"))
    return hot.unionByName(cold).unionByName(null).repartition(16)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_plain_join(spark, skewed, how):
    other = spark.range(1500).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("w"))
    other = other.unionByName(other.filter("k = 7"))  # two partners for the hot key
    got = spread_join(skewed, other, "k", how, hot_keys(skewed, "k", 100), 100)
    want = skewed.join(other, "k", how)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0
    assert want.exceptAll(got).count() == 0


def test_without_hot_keys_the_join_is_plain(spark, skewed):
    other = spark.range(10).select(F.col("id").cast("int").alias("k"))
    plan = spread_join(skewed, other, "k")._jdf.queryExecution().toString()
    assert "_part" not in plan


def test_spread_join_splits_the_hot_key(spark, skewed):
    assert [tuple(r) for r in hot_keys(skewed, "k", 100).collect()] == [(7, 3000)]
    other = spark.range(1500).select(F.col("id").cast("int").alias("k"), F.col("id").alias("w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = spread_join(skewed, other, "k", hot=hot_keys(skewed, "k", 100), hot_rows=100).filter("k = 7")
        tasks = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r["count"] for r in tasks) == 3000
    assert len(tasks) > 4
    assert max(r["count"] for r in tasks) < 1500


# Expectations and tests ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame([(1, 5), (2, 9), (3, None)], "id int, s int")


def test_violations_count_null_outcomes(scores):
    strict, lenient = Expectation("strict", "s <= 5"), Expectation("lenient", "s <= 5", True)
    got = {r["restricao"]: r["violacoes"] for r in violations(scores, [strict, lenient]).collect()}
    assert got == {"strict": 2, "lenient": 1}


def test_enforce(scores):
    rule = Expectation("s_max", "s <= 5")
    with pytest.raises(ExpectationError, match=r"s_max \(2 rows\)"):
        enforce(scores, [rule])
    assert one(enforce(scores, [rule], "drop"), "id") == [1]
    assert enforce(scores, [Expectation("any", "id > 0")]) is scores


def test_empty_totals_fail(spark):
    empty = spark.createDataFrame([], "x decimal(18,2)")
    assert one(reconcile_sum("t", empty, "x", empty, "x"), "passou") == [False]


def test_gate_names_every_failure(spark, scores):
    report = quality_report(
        [
            unique_key("b_keys", scores, ["id"]),
            volume_check("a_volume", scores, 10, 20),
            volume_check("c_volume", scores, 10, 20),
        ]
    )
    assert [(r["teste"], r["passou"]) for r in report.collect()] == [
        ("a_volume", False),
        ("b_keys", True),
        ("c_volume", False),
    ]
    with pytest.raises(QualityGateError, match="a_volume, c_volume"):
        quality_gate(report)
    with pytest.raises(Exception, match="a_volume, c_volume"):
        gate_result(report).collect()
    passed = report.filter("passou")
    quality_gate(passed)
    assert one(gate_result(passed), "resultado_final") == ["TODOS OS 1 TESTES PASSARAM"]


def test_unique_key_counts_extra_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,)], "k int")
    assert [(r["valor"], r["passou"]) for r in unique_key("u", df, ["k"]).collect()] == [("2", False)]
