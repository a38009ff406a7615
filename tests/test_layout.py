"""Hot keys found while writing, tables in buckets and months."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.landing_data import write_landing
from tidemark.operators.quality import orphan_count
from tidemark.operators.skew import confirmed, heavy_hitters, least_hot
from tidemark.plans import gold, marts
from tidemark.plans.pipeline import Run, attach, expire_runs, refresh, schema_of
from tidemark.schemas import manifest
from tidemark.sources.layout import MONTH
from tidemark.sources.tables import write_finding_hot
from workload.registry import Tables


@pytest.mark.parametrize("tracked", [16, 64, 1000])
def test_every_hot_key_is_a_candidate(spark, tracked):
    """Whatever the summary forgets, no key above the limit is missed, and counts are exact."""
    rng = random.Random(tracked)
    values = [k for k in range(2000) for _ in range(rng.choice([1, 1, 1, 2, 5]))]
    values += [5] * 4000 + [7] * 1500 + [11] * 400 + [None] * 3000
    rng.shuffle(values)
    df = spark.createDataFrame([(None if v is None else f"k{v}",) for v in values], "k string").repartition(13)
    hot_rows = 300
    found = df.agg(heavy_hitters("k", hot_rows, tracked).alias("x")).first()["x"]
    exact = Counter(v for v in values if v is not None)
    least = least_hot(len(values), hot_rows, tracked)
    names = {r["item"] for r in found}
    assert {f"k{v}" for v, n in exact.items() if n > least} <= names and None not in names
    assert all(r["count"] >= exact[int(r["item"][1:])] for r in found)
    hot = confirmed(df, "k", sorted(names), least)
    assert {r["k"]: r["_rows"] for r in hot.collect()} == {f"k{v}": n for v, n in exact.items() if n > least}


def test_the_limit_grows_with_the_table_only_when_it_must():
    assert least_hot(10**9) == 1_000_000
    assert least_hot(10**12) == 30_000_000
    assert least_hot(0) == 1_000_000


def test_nothing_is_counted_without_candidates(spark, tmp_path):
    seen, hot = write_finding_hot(spark.range(1000).selectExpr("cast(id AS string) k"), str(tmp_path / "a"), "k", 10)
    assert (seen["_rows"], hot) == (1000, None)
    assert not (tmp_path / "a_quentes").exists()
    seen, hot = write_finding_hot(spark.range(0).selectExpr("cast(id AS string) k"), str(tmp_path / "b"), "k", 10)
    assert (seen["_rows"], hot) == (0, None)
    many = spark.range(1000).selectExpr("if(id % 3 = 0, 'x', cast(id AS string)) AS k")
    seen, hot = write_finding_hot(many, str(tmp_path / "c"), "k", 10)
    assert [tuple(r) for r in hot.collect()] == [("x", 334)]


@pytest.fixture(scope="module")
def landing(spark, sf_dir, tmp_path_factory):
    from workload.registry import land

    return land(Tables(spark, sf_dir))


def stored(spark, landing, tmp_path_factory, **options):
    run = Run(spark, str(tmp_path_factory.mktemp("lake")), buckets=4, **options)
    run.bronze(landing, manifest())
    run.silver()
    run.gold(F.lit("2002-01-01").cast("date"))
    return run


@pytest.fixture(scope="module")
def run(spark, landing, tmp_path_factory):
    return stored(spark, landing, tmp_path_factory)


def exchanges_below_merge_joins(df):
    """The largest number of shuffles under any join of the plan, and how many such joins there are."""
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.toString().splitlines()
    joins, worst = 0, 0
    for k, line in enumerate(text):
        if "SortMergeJoin" in line:
            joins += 1
            depth = line.index("SortMergeJoin")
            below = []
            for other in text[k + 1 :]:
                name = other.lstrip(" :+-*()0123456789")
                if len(other) - len(name) <= depth - 3 and other.strip():
                    break
                below.append(name)
            worst = max(worst, sum(n.startswith("Exchange") for n in below))
    return joins, worst


@pytest.fixture
def merge_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def stored_fact(run):
    s = [run.read(f"silver.{n}") for n in ("itens_pedido", "pedidos", "clientes", "pagamentos", "avaliacoes")]
    return gold.sales_fact(*s, persons=run.read("silver.pedido_pessoa"))


def test_joins_by_order_do_not_shuffle(spark, run, merge_joins, sf_dir):
    assert exchanges_below_merge_joins(stored_fact(run)) == (4, 0)
    orders = run.read("silver.pedidos")
    lost = orphan_count(run.read("gold.fato_vendas"), "pedido_id", orders, "order_id")
    assert exchanges_below_merge_joins(lost) == (1, 0)
    totals = marts.order_totals(run.read("gold.fato_vendas"), repeats=True)
    assert "Exchange" not in totals._jdf.queryExecution().executedPlan().toString()
    plain = Tables(spark, sf_dir).fact()
    assert exchanges_below_merge_joins(plain)[1] > 0


def same(a, b):
    columns = sorted(set(a.columns) & set(b.columns))
    a, b = a.select(columns), b.select(columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_tables_are_those_of_the_plain_layout(spark, run, sf_dir):
    t = Tables(spark, sf_dir)
    assert same(run.read("gold.fato_vendas").drop("_processado_em"), t.fact())
    assert same(run.read("gold.pedido_totais"), marts.order_totals(t.fact(), repeats=True))
    assert same(run.read("gold.mart_vendas_mensal"), marts.monthly_sales(t.order_totals("data_compra", "cancelado")))


def test_a_month_reads_its_partition_only(spark, run):
    for name, build in (("gold.fato_vendas", lambda df: df), ("gold.pedido_totais", marts.monthly_sales)):
        table = run.read(name)
        months = sorted(r[0] for r in table.select(MONTH).distinct().collect())
        one = table.filter(F.col(MONTH) == months[3])
        files = one.inputFiles()
        assert files and all(f"/{MONTH}={months[3]}/" in f for f in files)
        assert len(files) < len(table.inputFiles()) / 5
        whole = build(table)
        if "ano" in whole.columns:
            whole = whole.filter(F.expr(f"ano * 100 + mes = {months[3]}"))
        else:
            whole = whole.filter(F.expr(f"year(data_compra) * 100 + month(data_compra) = {months[3]}"))
        assert same(build(one), whole) and not build(one).isEmpty()


def test_hot_orders_are_stored_without_buckets(spark, run, landing, tmp_path_factory):
    """About one order in a hundred has over nine items; the tables are the same."""
    hot = stored(spark, landing, tmp_path_factory, hot_rows=9)
    assert "order_items" in hot.hot and "silver.itens_pedido" not in hot.laid_out
    counts = run.read("silver.itens_pedido").groupBy("order_id").count().filter("count > 9")
    assert {tuple(r) for r in hot.hot["order_items"].collect()} == {tuple(r) for r in counts.collect()}
    for name in ("gold.fato_vendas", "gold.pedido_totais", "gold.mart_categoria_performance"):
        assert same(hot.read(name).drop("_processado_em", MONTH), run.read(name).drop("_processado_em", MONTH))


def test_a_catalog_that_lost_the_tables(spark, tmp_path):
    """Another session knows nothing of a run's tables; a switch to it brings them back."""
    run = refresh(spark, write_landing(tmp_path / "landing"), str(tmp_path / "lake"), fact_volume=(1, 100))
    before = {n: sorted(map(str, run.read(n).collect())) for n in run.laid_out}
    spark.sql(f"DROP SCHEMA {run.schema} CASCADE")
    attach(spark, run.root, run.run_id)
    attach(spark, run.root, run.run_id)  # twice is once
    assert {n: sorted(map(str, run.read(n).collect())) for n in run.laid_out} == before
    assert spark.table("gold.fato_vendas").count() == run.rows["gold.fato_vendas"]
    Run(spark, run.root, "later").write("silver.x", spark.range(1))
    Run(spark, run.root, "latest").write("silver.pedidos", spark.table("silver.pedidos"))
    assert spark.catalog.databaseExists(schema_of("latest"))
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema_of('later')}")
    assert expire_runs(spark, run.root, keep=1) == ["later"]
    assert spark.catalog.databaseExists(schema_of("latest")) and not spark.catalog.databaseExists(schema_of("later"))
    assert spark.table("gold.fato_vendas").count() == run.rows["gold.fato_vendas"]
