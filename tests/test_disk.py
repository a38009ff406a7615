"""What a load leaves on disk, and what its steps put there on the way, stays a small multiple of its input."""

import threading
import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.landing_data import write_landing
from tidemark.operators.distinct import RANGE, distinct_counts, distinct_sets
from tidemark.plans import marts, pipeline
from tidemark.plans.pipeline import Run
from tidemark.schemas import manifest
from tidemark.session import side_by_side
from tidemark.sources.bronze import landed_contents
from tidemark.sources.landing import read_modes
from workload import registry


@pytest.fixture
def bare_tables(monkeypatch):
    """Tables of a few columns, without notes and constraints."""
    monkeypatch.setattr(pipeline.descriptions, "COLUMNS", {})
    monkeypatch.setattr(pipeline.gate, "CONSTRAINTS", {})


def shuffle_files(spark):
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {name for k in range(blocks.size()) if (name := blocks.apply(k).getName()).startswith("shuffle_")}


@pytest.mark.parametrize("name", ["silver.pedidos", "gold.pessoa_totais"])  # with buckets and without
def test_shuffle_files_go_with_the_write_that_made_them(spark, tmp_path, bare_tables, name):
    before = shuffle_files(spark)
    rows = spark.range(5000).selectExpr("cast(id AS string) AS order_id", "id % 7 AS k").repartition(3, "k")
    kept = rows.groupBy("order_id").agg(F.max("k").alias("k"))  # whoever holds the frame doesn't hold the files
    Run(spark, str(tmp_path)).write(name, kept)
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert kept.count() == 5000 and kept.collect() == kept.collect()


def test_stored_tables_are_packed(spark, tmp_path, bare_tables):
    run = Run(spark, str(tmp_path))
    rows = spark.range(100).selectExpr("cast(id AS string) AS order_id", "id AS k")
    for name in ("silver.pedidos", "gold.pessoa_totais", "bronze.orders"):
        run.write(name, rows)
        parts = list(Path(run.path(name)).rglob("*.parquet"))
        found = {pq.ParquetFile(p).metadata.row_group(0).column(k).compression for p in parts if pq.ParquetFile(p).metadata.num_rows for k in (0, 1)}
        assert found == {"ZSTD"}
        assert {tuple(r) for r in run.read(name).collect()} == {(str(k), k) for k in range(100)}


def running_together(spans):
    """Pairs of names whose time spans overlap."""
    return {(a, b) for a, (s, e) in spans.items() for b, (t, f) in spans.items() if a < b and s < f and t < e}


def test_jobs_that_fill_the_cluster_run_alone():
    spans = {}

    def work(name):
        began = time.time()
        time.sleep(0.05)
        spans[name] = (began, time.time())
        return name.upper()

    assert side_by_side(work, "abcdef", alone=["e", "b"]) == list("ABCDEF")
    together = running_together(spans)
    assert together and not any({"b", "e"} & set(pair) for pair in together)
    assert side_by_side(work, iter("ab")) == ["A", "B"]
    with pytest.raises(ZeroDivisionError):
        side_by_side(lambda k: 1 // int(k), ["1", "0"], alone=["0"])


def test_large_tables_are_dealt_one_at_a_time(spark, tmp_path, monkeypatch):
    run = Run(spark, str(tmp_path / "lake"))
    run.bronze(write_landing(tmp_path / "landing"), manifest())
    large = [n for n, k in run.rows.items() if k > 4]
    assert {"bronze.order_items", "bronze.order_payments", "bronze.orders"} <= set(large)
    monkeypatch.setattr(pipeline, "BUCKET_ROWS", 4)
    spans, lock, write = {}, threading.Lock(), run.write

    def watched(name, *args):
        began = time.time()
        rows = write(name, *args)
        with lock:
            spans[name] = (began, time.time())
        return rows

    monkeypatch.setattr(run, "write", watched)
    run.silver()
    moved = {"silver.itens_pedido", "silver.pagamentos", "silver.pedidos"}
    together = running_together(spans)
    assert not any(moved & set(pair) for pair in together) and len(spans) == 9
    assert run.rows["silver.itens_pedido"] == run.rows["bronze.order_items"]


@pytest.fixture
def merge_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def sales(spark, tmp_path, bare_tables):
    """A stored fact with repeated items, cancelled orders, a product without category, one unknown, one only cancelled."""
    run = Run(spark, str(tmp_path), buckets=4)
    fact = spark.range(3000).selectExpr(
        "'o' || id div 5 AS pedido_id",
        "cast(id % 5 AS int) AS item_id",
        "CASE WHEN id div 5 % 10 = 0 THEN 'k99' ELSE 'k' || (id * 7 % 11) END AS produto_id",
        "CASE WHEN id div 5 % 37 = 1 THEN NULL ELSE id div 5 % 10 = 0 END AS cancelado",
        "CASE WHEN id div 5 % 41 = 2 THEN NULL ELSE timestamp'2017-01-15 10:00:00' + make_dt_interval(cast(id div 5 % 90 AS int)) END AS data_compra",
        "cast(id % 100 AS decimal(19,2)) AS receita",
        "cast(id div 5 % 5 + 1 AS double) AS nota_avaliacao",
    )
    fact = fact.unionByName(fact.filter("item_id = 2"))
    products = spark.range(100).filter("id <> 10").selectExpr("'k' || id AS product_id", "CASE WHEN id % 4 <> 3 THEN 'c' || id % 4 || IF(id = 99, 'x', '') END AS categoria_en")
    products = products.withColumn("categoria_en", F.expr("IF(product_id = 'k99', 'never', categoria_en)"))
    run.write("gold.fato_vendas", fact)
    run.write("gold.dim_produto", products)
    run.write("gold.pedido_numero", marts.order_numbers(run.read("gold.fato_vendas")))
    return run


def moved_by_order(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange" in line and "pedido_id" in line]


def test_orders_get_their_numbers_without_a_shuffle(sales, merge_joins):
    fact, products = sales.read("gold.fato_vendas"), sales.read("gold.dim_produto")
    sets = marts.order_sets(fact, products, sales.read("gold.pedido_numero"))
    assert not moved_by_order(sets)
    plain = marts.category_performance(fact, products)
    counts = {tuple(r) for r in distinct_counts(sets, "categoria_en").collect()}
    assert counts == {(r["categoria_en"], r["pedidos"]) for r in plain.collect()} and len(counts) > 3
    by_month = marts.sold(fact).join(products, F.col("produto_id") == F.col("product_id"), "left")
    by_month = by_month.groupBy("ano_mes", F.coalesce("categoria_en", F.lit(marts.UNCATEGORISED)).alias("c")).agg(F.count_distinct("pedido_id"))
    assert {tuple(r) for r in distinct_counts(sets, "ano_mes", "categoria_en").collect()} == {tuple(r) for r in by_month.collect()}
    assert sets.groupBy("ano_mes", "categoria_en", RANGE).count().filter("count > 1").isEmpty()


def test_categories_count_orders_in_their_sets(sales, merge_joins):
    fact, products = sales.read("gold.fato_vendas"), sales.read("gold.dim_produto")
    sales.write("gold.pedido_categoria_mes", marts.order_sets(fact, products, sales.read("gold.pedido_numero")))
    counted = marts.category_performance(fact, products, sales.read("gold.pedido_categoria_mes"))
    plain = marts.category_performance(fact, products)
    assert counted.dtypes == plain.dtypes and moved_by_order(plain) and not moved_by_order(counted)
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, plain.collect()))
    none = marts.category_performance(fact.limit(0), products, sales.read("gold.pedido_categoria_mes"))
    assert none.isEmpty()


def test_numbers_that_hardly_repeat_are_moved_once(spark):
    rows = spark.range(9000).selectExpr("cast(id % 7 AS int) AS mes", "id div 3 AS numero")
    rows = rows.unionByName(rows.limit(500)).unionByName(spark.sql("SELECT 1 AS mes, cast(NULL AS bigint) AS numero"))
    once, twice = distinct_sets(rows, "mes", repeats=False), distinct_sets(rows, "mes")
    shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert (shuffles(once), shuffles(twice)) == (1, 2)
    assert {tuple(r) for r in distinct_counts(once, "mes").collect()} == {tuple(r) for r in distinct_counts(twice, "mes").collect()}


def test_packed_drops_have_the_rows_of_plain_ones(spark, sf_dir):
    t = registry.Tables(spark, sf_dir)
    plain, packed = registry.land(t), registry.land(t, **{**registry.PACKED, "maxRecordsPerFile": 500})
    parts = [p for p in Path(packed.removeprefix("file:")).rglob("part-*")]
    assert parts and all(p.name.endswith(".csv.gz") for p in parts)
    assert len([p for p in parts if "order_items" in str(p)]) >= 6000 // 500
    size = lambda at: sum(p.stat().st_size for p in Path(at.removeprefix("file:")).rglob("part-*"))
    assert size(packed) < size(plain) / 2

    def found(at):
        return {tuple(r) for r in landed_contents(spark, at, manifest(), read_modes(spark, at, list(manifest().values()))).collect()}

    assert found(plain) == found(packed)


def test_a_load_leaves_no_drops_and_a_counted_one_nothing(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "shared_folder", lambda s: str(tmp_path))
    schemas = lambda: {r[0] for r in spark.sql("SHOW SCHEMAS").collect()}
    before = schemas()
    rows = {r["tabela"]: r["linhas"] for r in registry.QUERIES["refresh_tables"](spark, sf_dir).collect()}
    assert rows["bronze.order_items"] == rows["gold.fato_vendas"] == 6000
    assert not [p for p in tmp_path.rglob("*") if p.is_file()] and schemas() == before
    run = registry.whole_load(registry.Tables(spark, sf_dir))
    assert not (tmp_path / "landing").exists()
    assert run.read("bronze.order_items").count() == run.read("gold.fato_vendas").count() == 6000
