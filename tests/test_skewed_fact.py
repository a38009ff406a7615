"""The fact with an order that holds a third of all items, against a plain join."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.skew import HOT_ROWS, confirmed, heavy_hitters, hot_keys, least_hot, spread_join
from tidemark.plans import gold, marts
from tidemark.plans.silver import clean_products
from workload.registry import Tables


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    t = Tables(spark, sf_dir)
    items = t.silver("itens_pedido")
    hot = items.withColumn("order_id", F.when(F.col("item_id") <= 2, F.lit("1")).otherwise(F.col("order_id")))
    return t, hot


def test_hot_order(tables):
    t, items = tables
    rest = [t.silver(n) for n in ("pedidos", "clientes", "pagamentos", "avaliacoes")]
    split = gold.sales_fact(items, *rest, hot=hot_keys(items, "order_id", 50), hot_rows=50)
    plain = gold.sales_fact(items, *rest)
    assert "_part" in split._jdf.queryExecution().toString()
    assert split.count() == items.count()
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()


@pytest.mark.parametrize("layout", ["one task", "every second task"])
def test_clustered_hot_key_is_spread(spark, layout):
    """10,000 rows of one key in one input task, or in the tasks of one residue."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        hot = spark.range(10_000).selectExpr("'hot' AS k", "id AS v")
        if layout == "one task":
            big = hot.coalesce(1).unionByName(spark.range(0, 300, 1, 3).selectExpr("cast(id AS string) AS k", "id AS v"))
        else:
            rows = spark.range(0, 20_000, 1, 20)
            big = rows.selectExpr("if(spark_partition_id() % 2 = 0, 'hot', cast(id AS string)) AS k", "id AS v")
        other = big.select("k").distinct().withColumn("w", F.lit(1))
        joined = spread_join(big, other, "k", hot=hot_keys(big, "k", 1000), hot_rows=1000)
        assert joined.count() == big.count()
        tasks = joined.filter("k = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(tasks) >= 7  # ten parts; a few may share a task
        assert max(r["count"] for r in tasks) < 3_600
        parts = big.filter("k = 'hot'").groupBy(
            F.pmod(F.pmod(F.xxhash64("k", "v"), F.lit(1 << 30)).cast("int") + F.spark_partition_id(), F.lit(10)).alias("p")
        ).count().collect()
        assert max(r["count"] for r in parts) < 1_300
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_unused_sides_and_columns_are_not_read(tables):
    """Category sales don't read payments, and push the cancelled filter down."""
    t, _ = tables
    plan = marts.category_performance(t.fact(), t.products())._jdf.queryExecution().executedPlan().toString()
    assert "l_returnflag" not in plan and "l_tax" in plan
    assert "o_orderstatus" in plan.split("DataFilters")[1] or "NOT CASE" in plan


@pytest.fixture
def small_skew_limits(spark):
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40kb",
    }
    for key, value in limits.items():
        spark.conf.set(key, value)
    yield
    for key in limits:
        spark.conf.unset(key)


def skew_split(df):
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_hot_product_is_split_at_run_time(spark, tmp_path, small_skew_limits):
    """A third of the fact sells one product, another third an unknown (NULL) one."""
    sold = spark.range(120_000).selectExpr(
        "cast(id div 2 AS string) AS pedido_id",
        "CASE id % 3 WHEN 0 THEN '7' WHEN 1 THEN cast(id % 1000 AS string) END AS produto_id",
        "false AS cancelado",
        "cast(id % 100 AS decimal(19,2)) AS receita",
        "cast(id % 5 + 1 AS double) AS nota_avaliacao",
    )
    sold.repartition(16).write.parquet(str(tmp_path / "fact"))
    products = spark.range(1000).selectExpr(
        "cast(id AS string) AS product_id", "cast(id % 9 AS string) AS categoria_en"
    )
    mart = marts.category_performance(spark.read.parquet(str(tmp_path / "fact")), products)
    assert skew_split(mart)
    assert sum(r["itens_vendidos"] for r in mart.collect()) == 120_000


def test_hot_customer_id_and_hot_category_are_split_at_run_time(spark, tmp_path, small_skew_limits):
    orders = spark.range(60_000).selectExpr(
        "cast(id AS string) AS order_id",
        "CASE WHEN id % 3 = 0 THEN '7' ELSE cast(id AS string) END AS customer_id",
        "timestamp'2017-01-01' + make_dt_interval(cast(id % 500 AS int)) AS data_compra",
        "false AS cancelado",
    )
    orders.repartition(16).write.parquet(str(tmp_path / "orders"))
    customers = spark.range(60_000).selectExpr(
        "cast(id AS string) AS customer_id",
        "cast(id % 5000 AS string) AS customer_unique_id",
        "'A' AS cidade",
        "'SP' AS uf",
        "'00000' AS cep_prefixo",
    )
    items = spark.range(60_000).selectExpr(
        "cast(id AS string) AS order_id", "cast(1 AS decimal(19,2)) AS valor_item"
    )
    persons = gold.person_dimension(customers, spark.read.parquet(str(tmp_path / "orders")), items)
    assert skew_split(persons)
    assert sum(r["total_pedidos"] for r in persons.collect()) == 60_000

    names = ("product_name_lenght", "product_description_lenght", "product_photos_qty",
             "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
    raw = spark.range(60_000).selectExpr(
        "cast(id AS string) AS product_id",
        "CASE WHEN id % 3 = 0 THEN 'c7' ELSE 'c' || (id % 2000) END AS product_category_name",
        *(f"cast(id % 100 AS string) AS {n}" for n in names),
    )
    raw.repartition(16).write.parquet(str(tmp_path / "products"))
    translation = spark.range(2000).selectExpr(
        "'c' || id AS product_category_name", "'e' || id AS product_category_name_english"
    )
    assert skew_split(clean_products(spark.read.parquet(str(tmp_path / "products")), translation))
