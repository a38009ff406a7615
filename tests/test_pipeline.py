"""The full refresh on the hand-written landing folder."""

import datetime
import json
import threading
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.landing_data import ROWS, write_landing
from tidemark.operators.expectations import ExpectationError
from tidemark.operators.quality import QualityGateError
from tidemark.plans import kpis
from tidemark.plans.pipeline import Run, expire_runs, published, refresh, repair, switch
from tidemark.schemas import manifest
from tidemark.sources.landing import ArrivalError
from tidemark.sources.tables import write_text

VOLUME = (1, 100)
AS_OF = datetime.date(2017, 3, 1)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("lake")
    landing = write_landing(folder / "landing")
    return refresh(spark, landing, str(folder / "lake"), fact_volume=VOLUME, as_of=F.lit(AS_OF))


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_names_resolve(spark, run):
    assert spark.table("bronze.orders").count() == 5
    assert spark.table("silver.avaliacoes").count() == 3
    assert spark.sql("SELECT total_pedidos FROM gold.vw_metricas_gerais").first()[0] == 3
    assert spark.table("_resultados_testes").count() == 16
    text = {c.name: c.description for c in spark.catalog.listColumns("gold.fato_vendas")}
    assert "do not sum" in text["valor_pago"]
    assert "Sales" in spark.catalog.getTable("gold.fato_vendas").description
    assert "orders.csv" in spark.catalog.getTable("bronze.orders").description
    assert spark.table("bronze._raw_arquivos").count() == 9


def test_audit_counts_the_source(spark, run):
    row = spark.table("silver.avaliacoes").first()
    assert row["_linhas_origem"] == 4  # before the dedup
    assert row["_processado_em"] is not None


def test_types(spark, run):
    types = dict(spark.table("gold.fato_vendas").dtypes)
    assert types["preco"] == "decimal(18,2)"
    assert types["receita"] == "decimal(19,2)"
    assert types["data_compra"] == "timestamp"
    assert types["item_id"] == "int"
    assert types["nota_avaliacao"] == "double"
    assert dict(spark.table("gold.mart_geografia").dtypes)["receita"] == "decimal(29,2)"


def test_orders(spark, run):
    orders = by(spark.table("silver.pedidos"), "order_id")
    assert orders["o1"]["tempo_entrega_dias"] == 1
    assert orders["o1"]["atraso_dias"] == -5
    assert orders["o3"]["entregue"] and orders["o3"]["tempo_entrega_dias"] is None
    assert orders["o4"]["data_estimada_entrega"] is None
    assert orders["o5"]["data_estimada_entrega"] is None


def test_person_history(spark, run):
    persons = by(spark.table("gold.dim_cliente"), "customer_unique_id")
    p1 = persons["p1"]
    assert p1["total_pedidos"] == 2
    assert p1["receita_acumulada"] == Decimal("34.00")  # the cancelled order adds nothing
    assert (p1["cidade"], p1["uf"], p1["cep_prefixo"]) == ("Rio De Janeiro", "RJ", "00123")
    assert p1["data_ultimo_pedido"] == datetime.datetime(2017, 1, 30, 23, 59)
    assert p1["dias_sem_comprar"] == 30
    only_cancelled = persons["p3"]
    assert only_cancelled["receita_acumulada"] == 0
    assert only_cancelled["data_primeiro_pedido"] is None


def test_fact(spark, run):
    fact = {(r["pedido_id"], r["item_id"]): r for r in spark.table("gold.fato_vendas").collect()}
    assert len(fact) == len(ROWS["order_items"])
    assert {fact["o1", i]["valor_pago"] for i in (1, 2)} == {Decimal("34.00")}
    assert fact["o1", 1]["metodo_pagamento_principal"] == "credit_card"
    assert fact["o1", 1]["nota_avaliacao"] == 4.5
    assert fact["o3", 1]["metodo_pagamento_principal"] is None  # its only sequence is unreadable
    assert fact["o3", 1]["valor_pago"] == Decimal("5.00")
    assert fact["o5", 1]["valor_pago"] is None


def test_categories(spark, run):
    rows = by(spark.table("gold.mart_categoria_performance"), "categoria_en")
    assert set(rows) == {"furniture", "beleza", "sem_categoria"}
    assert rows["furniture"]["itens_vendidos"] == 2


def test_unknown_seller_stays(spark, run):
    rows = by(spark.table("gold.mart_vendedor_performance"), "vendedor_id")
    assert rows["s9"]["cidade"] is None and rows["s9"]["itens_vendidos"] == 1


def test_payment_mix_counts(spark, run):
    per_order = by(spark.table("gold.vw_metodo_pagamento_por_pedido"), "metodo_pagamento")
    per_item = by(spark.table("gold.vw_metodo_pagamento"), "metodo_pagamento")
    assert per_order["credit_card"]["total_pedidos"] == 1
    assert per_order["credit_card"]["valor_total_pago"] == Decimal("34.00")
    assert per_item["credit_card"]["total_pedidos"] == 2
    assert per_item["credit_card"]["valor_total_pago"] == Decimal("68.00")
    assert per_order["nao_informado"]["total_pedidos"] == 2


def test_cancellations(spark, run):
    feb = spark.table("gold.vw_taxa_cancelamento").filter("mes = 2").first()
    assert (feb["total_pedidos"], feb["pedidos_cancelados"]) == (3, 1)  # o4 has no items
    every = kpis.cancellation_rate(spark.table("silver.pedidos"), "order_id").filter("mes = 2").first()
    assert (every["total_pedidos"], every["pedidos_cancelados"]) == (4, 2)
    assert every["taxa_cancelamento_pct"] == Decimal("50.00")


def test_geography_uses_latest_address(spark, run):
    rows = by(spark.table("gold.mart_geografia"), "uf")
    assert rows["RJ"]["receita"] == Decimal("34.00")
    assert (rows["SP"]["clientes_unicos"], rows["SP"]["pedidos"]) == (2, 2)


def test_mean_point(spark, run):
    points = by(spark.table("silver.geolocalizacao"), "cep_prefixo")
    assert points["01310"]["latitude"] == pytest.approx(-23.6)
    assert points["01310"]["qtd_pontos_origem"] == 2
    assert points["00123"]["latitude"] is None and points["00123"]["cidade"] is None


def test_all_tests_green(run):
    report = run.read("gold.relatorio_testes").collect()
    assert len(report) == 16
    assert all(r["passou"] for r in report)


def failing(spark, folder, error, match, volume=VOLUME, **changed):
    landing = write_landing(folder / "landing", **changed)
    with pytest.raises(error, match=match):
        refresh(spark, landing, str(folder / "lake"), fact_volume=volume)


def test_each_fault_stops_the_run(spark, run, tmp_path):
    before = shown(spark, "gold.fato_vendas")
    orders, items = ROWS["orders"], ROWS["order_items"]
    failing(spark, tmp_path / "a", ArrivalError, "empty", sellers=[])
    failing(
        spark,
        tmp_path / "b",
        ExpectationError,
        "preco_nao_negativo",
        order_items=[*items[:-1], ("o5", "1", "k1", "s9", "", "-7.00", "1.00")],
    )
    failing(
        spark,
        tmp_path / "c",
        ExpectationError,
        "nota_entre_1_e_5",
        order_reviews=[("r1", "o1", "9", "", "", "", "")],
    )
    failing(
        spark,
        tmp_path / "d",
        ExpectationError,
        "data_compra_nao_nula",
        orders=[*orders[:-1], ("o5", "c5", "shipped", "someday", "", "", "", "")],
    )
    # an item whose order never arrived: its revenue is missing from the fact
    failing(
        spark,
        tmp_path / "e",
        QualityGateError,
        "failed|falharam: receita_gold_igual_silver$",
        order_items=[*items, ("o9", "1", "k1", "s1", "", "1.00", "0.00")],
    )
    failing(spark, tmp_path / "f", QualityGateError, "falharam: volume_fato_vendas$", (100, 200))
    # a repeated item number breaks the grain and nothing else
    failing(
        spark,
        tmp_path / "g",
        QualityGateError,
        "falharam: chave_unica_fato_vendas$",
        order_items=[*items, items[0]],
    )
    assert before == shown(spark, "gold.fato_vendas")  # readers still see the last good run


def shown(spark, name):
    """The text behind a published name."""
    return spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'View Text'").first()["data_type"]


@pytest.fixture(scope="module")
def second(spark, run, tmp_path_factory):
    """Another run of the same lake, not published yet."""
    landing = write_landing(tmp_path_factory.mktemp("again") / "landing", sellers=[*ROWS["sellers"], ("s3", "1", "x", "SP")])
    again = Run(spark, run.root)
    again.bronze(landing, manifest())
    again.silver()
    again.gold()
    again.test(VOLUME)
    return again


def test_metrics_are_views_over_the_published_tables(spark, run):
    assert "gold.pessoa_totais" in shown(spark, "gold.vw_metricas_gerais")
    assert "gold.pedido_totais" in shown(spark, "gold.vw_taxa_cancelamento")
    assert "gold.fato_vendas" in shown(spark, "gold.vw_metodo_pagamento")
    assert "gold.mart_categoria_performance" in shown(spark, "gold.vw_top10_categorias")


def test_a_failed_switch_goes_back(spark, run, second, monkeypatch):
    real, calls = spark.sql, []

    def failing_sql(text, *args, **kwargs):
        if text.startswith("CREATE OR REPLACE VIEW gold.mart") and second.run_id in text:
            raise RuntimeError("catalog lost")
        calls.append(text)
        return real(text, *args, **kwargs)

    monkeypatch.setattr(spark, "sql", failing_sql, raising=False)
    with pytest.raises(RuntimeError, match="catalog lost"):
        second.publish()
    monkeypatch.undo()
    assert any(second.run_id in c for c in calls)
    names = [s.split()[4] for s in run.statements()]
    assert not any(second.run_id in shown(spark, n) for n in names)
    assert published(spark, run.root) == run.run_id


def test_a_lost_switch_is_completed_and_readers_never_miss_a_name(spark, run, second):
    missing, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                spark.sql("SELECT count(*) FROM silver.vendedores").first()
            except Exception as error:  # noqa: BLE001
                missing.append(str(error))

    statements = second.statements()
    write_text(spark, f"{second.path('')}names.json", json.dumps(statements))
    write_text(spark, f"{run.root}/published.json", json.dumps({"run": run.run_id, "next": second.run_id}))
    reader = threading.Thread(target=read, daemon=True)
    reader.start()
    try:
        switch(spark, statements[:5])
        assert repair(spark, run.root) == second.run_id
        for _ in range(2):
            run.publish()
            second.publish()
    finally:
        stop.set()
        reader.join(60)
    assert missing == []
    assert spark.table("silver.vendedores").count() == 3
    assert published(spark, run.root) == second.run_id
    run.publish()
    assert spark.table("silver.vendedores").count() == 2


def test_expired_runs_go_but_never_the_published_one(spark, run, second):
    third = Run(spark, run.root)
    third.write("silver.x", spark.range(1))
    assert published(spark, run.root) == run.run_id
    gone = expire_runs(spark, run.root, keep=1)
    assert second.run_id in gone and run.run_id not in gone and third.run_id not in gone
    assert spark.table("gold.fato_vendas").count() == len(ROWS["order_items"])


def test_quarantine(spark, tmp_path):
    items = [*ROWS["order_items"], ("o5", "2", "k1", "s1", "", "free", "1.00"), ("o5", "3", "k1", "s1", "", "1.00", "")]
    landing = write_landing(tmp_path / "landing", order_items=items)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|free"):
        refresh(spark, landing, str(tmp_path / "lake"), fact_volume=VOLUME)
    run = Run(spark, str(tmp_path / "lake"))
    run.bronze(landing, manifest())
    run.silver("quarantine")
    aside = run.read("quarantine.order_items").collect()
    assert sorted((r["order_item_id"], r["price"]) for r in aside) == [("2", "free")]
    assert run.rows["silver.itens_pedido"] + len(aside) == run.rows["bronze.order_items"] == len(items)
    assert run.rows["quarantine.order_payments"] == 0
