"""A refresh of what changed gives the tables of a full one, and leaves other months' files alone."""

import datetime
import shutil

import pytest
from pyspark.sql import functions as F

from tests.landing_data import ROWS, write_landing
from tidemark.operators.checksum import contents
from tidemark.operators.distinct import distinct_counts
from tidemark.operators.quality import QualityGateError
from tidemark.plans.changed import changed_keys, refresh_changed
from tidemark.plans.pipeline import Run, expire_runs, published, refresh
from tidemark.schemas import manifest
from tidemark.sources.layout import MONTH
from workload.registry import ANY_VOLUME, Tables, land, write_csv

STAMPS = ("_processado_em", "_ingerido_em")
NUMBERED = ("gold.pessoa_numero", "gold.pedido_numero", "gold.pessoa_mes", "gold.pedido_categoria_mes")


def as_of():
    return F.lit(datetime.date(2002, 1, 1))


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    """Two years of the provided tables, one line of each number in an order."""
    t = Tables(spark, sf_dir)
    t.raw["orders"] = t.raw["orders"].filter("order_purchase_timestamp BETWEEN '1995' AND '1997'")
    items = t.raw["order_items"].join(t.raw["orders"], "order_id", "left_semi")
    key = ["order_id", "order_item_id"]
    one = items.groupBy(*key).agg(F.min(F.struct(*(c for c in items.columns if c not in key))).alias("one"))
    t.raw["order_items"] = one.select(*key, "one.*").select(items.columns)
    return t


@pytest.fixture(scope="module")
def lake(spark, tables, tmp_path_factory):
    """A published run over the provided tables without repeated items."""
    root, landing = str(tmp_path_factory.mktemp("lake")), land(tables)
    run = refresh(spark, landing, root, fact_volume=ANY_VOLUME, as_of=as_of(), run_id="r1", buckets=2)
    return run, landing


def changed_drops(tables, landing, names):
    """The landing folder with some drops changed: cancelled, moved, lost and new orders, another address."""
    o = "cast(order_id AS bigint)"
    ways = {
        "orders": lambda df: df.filter(f"{o} % 311 <> 0").withColumns(
            {
                "order_status": F.when(F.expr(f"{o} % 397 = 0"), "canceled").otherwise(F.col("order_status")),
                "order_purchase_timestamp": F.when(F.expr(f"{o} % 431 = 0"), "1996-02-10 10:00:00").otherwise(
                    F.col("order_purchase_timestamp")
                ),
            }
        ),
        "order_items": lambda df: df.filter(f"{o} % 311 <> 0").withColumn(
            "price", F.when(F.expr(f"{o} % 401 = 0"), "7.25").otherwise(F.col("price"))
        ),
        "order_payments": lambda df: df.filter(f"{o} % 251 <> 0"),
        "customers": lambda df: df.withColumn(
            "customer_state", F.when(F.expr("cast(customer_id AS bigint) % 389 = 0"), "zz").otherwise(F.col("customer_state"))
        ),
        "sellers": lambda df: df.withColumn("seller_city", F.concat(F.lit("new "), "seller_city")),
        "products": lambda df: df.withColumn("product_category_name", F.when(F.col("product_id") > "3", F.col("product_category_name"))),
    }
    folder = landing + "-changed"
    shutil.rmtree(folder, ignore_errors=True)
    shutil.copytree(landing, folder)
    for name in names:
        path = f"{folder}/{manifest()[name]}"
        shutil.rmtree(path)
        write_csv(ways[name](tables.raw[name]), path)
    return folder


def same(a, b):
    """Number, sum and exclusive or of row hashes agree; as in ``operators.checksum``, tested on its own."""
    columns = [c for c in a.columns if c not in STAMPS]
    return contents(a, columns).first() == contents(b, columns).first()


def bare(landing):
    return landing.removeprefix("file:")


def test_tables_equal_a_full_refresh(spark, tables, lake, tmp_path):
    base, landing = lake
    names = ("orders", "order_items", "order_payments", "customers", "products")
    folder = changed_drops(tables, bare(landing), names)
    run = refresh_changed(spark, folder, base.root, fact_volume=ANY_VOLUME, as_of=as_of(), run_id="c1")
    full = refresh(spark, folder, str(tmp_path / "full"), fact_volume=ANY_VOLUME, as_of=as_of(), buckets=2)
    made = [n for n in full.rows if n not in NUMBERED]
    different = [n for n in made if full.rows[n] != run.rows[n] or not same(full.read(n), run.read(n))]
    assert different == []
    for name, groups in (("gold.pessoa_mes", (MONTH, "uf")), ("gold.pedido_categoria_mes", (MONTH, "categoria_en"))):
        assert same(distinct_counts(full.read(name), *groups), distinct_counts(run.read(name), *groups))
    # what no changed drop touches keeps its files
    touched = {f"bronze.{n}" for n in names}
    assert {n for n in run.rows if n.startswith("bronze.") and n not in run.places} == touched
    ids = run.read("mudancas.ids_pedido").select(F.col("order_id").alias("pedido_id"))
    facts = [r.read("gold.fato_vendas") for r in (base, run)]
    months = {r[0] for fact in facts for r in fact.join(ids, "pedido_id", "left_semi").select(MONTH).distinct().collect()}
    old, new = (set(fact.inputFiles()) for fact in facts)
    untouched = {f for f in old if not any(f"/{MONTH}={m}/" in f for m in months)}
    assert months and untouched == old & new


def test_a_change_without_orders(spark, tables, lake):
    base, landing = lake
    base.publish()
    folder = changed_drops(tables, bare(landing), ("sellers",))
    run = refresh_changed(spark, folder, base.root, fact_volume=ANY_VOLUME, as_of=as_of(), run_id="s1")
    for name in ("gold.fato_vendas", "gold.mart_vendas_mensal", "gold.pessoa_mes", "silver.pedidos"):
        assert sorted(run.read(name).inputFiles()) == sorted(base.read(name).inputFiles())
    cities = {r["cidade"].split()[0] for r in run.read("gold.mart_vendedor_performance").collect()}
    assert cities == {"New"} and run.rows["mudancas.ids_pedido"] == 0
    assert same(run.read("gold.dim_cliente"), base.read("gold.dim_cliente"))


def test_runs_whose_files_are_shown_stay(spark, tables, lake):
    """After the run above: the same drops once more."""
    base, landing = lake
    assert published(spark, base.root) == "s1"
    folder = changed_drops(tables, bare(landing), ("sellers",))
    again = refresh_changed(spark, folder, base.root, fact_volume=ANY_VOLUME, as_of=as_of(), run_id="s2")
    assert again.uses() == sorted([base.run_id, "s1", "s2"]) and again.rows["mudancas.ids_pedido"] == 0
    spark.sql(f"DROP SCHEMA {again.schema} CASCADE")  # a session that knows nothing of it
    loaded = Run.load(spark, base.root, "s2")
    assert same(loaded.read("gold.fato_vendas"), base.read("gold.fato_vendas"))
    assert expire_runs(spark, base.root, keep=1) == ["c1"]
    assert spark.table("gold.fato_vendas").count() == base.rows["gold.fato_vendas"]


def test_changed_keys(spark):
    a = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("c", None), (None, 3), ("e", 5)], "k string, v int")
    b = spark.createDataFrame([("a", 1), ("b", 3), ("c", None), ("d", 4), (None, 4), ("e", 5)], "k string, v int")
    assert sorted(r["k"] for r in changed_keys(a, b, "k").collect()) == ["a", "b", "d"]


def test_a_fault_in_a_changed_drop_stops(spark, tmp_path):
    """The first call is a full refresh; the published run stays when the second one fails."""
    volume = (1, 100)
    first = refresh_changed(spark, write_landing(tmp_path / "a"), str(tmp_path / "lake"), fact_volume=volume)
    items = [*ROWS["order_items"], ROWS["order_items"][0]]
    with pytest.raises(QualityGateError, match="chave_unica_fato_vendas"):
        refresh_changed(spark, write_landing(tmp_path / "b", order_items=items), str(tmp_path / "lake"), fact_volume=volume)
    assert published(spark, first.root) == first.run_id
    assert spark.table("gold.fato_vendas").count() == len(ROWS["order_items"])
