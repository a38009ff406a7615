"""The constraints and data tests of the retail tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.expectations import Expectation
from tidemark.operators.quality import (
    beside,
    duplicate_count,
    no_rows,
    orphan_count,
    rows_of,
    same_amount,
    volume,
)

ZIP = Expectation("cep_prefixo_5_digitos", "length(cep_prefixo) = 5")

# The constraint names and conditions of each table.
CONSTRAINTS: dict[str, tuple[Expectation, ...]] = {
    "clientes": (ZIP, Expectation("uf_2_letras", "length(uf) = 2")),
    "pedidos": (Expectation("data_compra_nao_nula", "data_compra IS NOT NULL"),),
    "vendedores": (ZIP,),
    "itens_pedido": (Expectation("preco_nao_negativo", "preco >= 0"),),
    "avaliacoes": (Expectation("nota_entre_1_e_5", "nota BETWEEN 1 AND 5"),),
    "geolocalizacao": (ZIP,),
    "fato_vendas": (
        Expectation("grao_item_unico", "pedido_id IS NOT NULL AND item_id IS NOT NULL"),
    ),
}

# Accepted size of the fact for the original data set; other data pass their own.
FACT_VOLUME = (100_000, 120_000)


def gate_report(
    fact: DataFrame,
    items: DataFrame,
    orders: DataFrame,
    persons: DataFrame,
    geography: DataFrame,
    categories: DataFrame,
    months: DataFrame,
    fact_volume: tuple[int, int] = FACT_VOLUME,
    totals: DataFrame | None = None,
) -> DataFrame:
    """The nine release tests. All plain fact numbers come from one pass over the fact.

    ``totals`` may bring the stored ``order_totals`` of the fact, whose keys and item counts are
    enough for the orphan tests.
    """
    col = F.col
    keyed, weight = (fact, None) if totals is None else (totals, "itens")
    numbers = beside(
        fact.agg(
            F.sum("receita").alias("fato"),
            F.sum(F.when(~col("cancelado"), col("receita"))).alias("fato_valido"),
            F.count(F.lit(1)).alias("linhas"),
            F.count_if(~col("nota_avaliacao").between(1, 5)).alias("notas_ruins"),
        ),
        items.agg(F.sum("valor_item").alias("itens")),
        orders.agg(F.count_if(col("data_compra").isNull()).alias("sem_data")),
        geography.agg(F.count_if(F.length("cep_prefixo") != 5).alias("ceps_ruins")),
        categories.agg(F.sum("receita").alias("categorias")),
        months.agg(F.sum("receita").alias("meses")),
        orphan_count(keyed, "pedido_id", orders, "order_id", weight).withColumnRenamed(
            "n", "sem_pedido"
        ),
        orphan_count(keyed, "cliente_id", persons, "customer_unique_id", weight).withColumnRenamed(
            "n", "sem_cliente"
        ),
    )
    # The test names are fixed values.
    checks = [
        same_amount("receita_gold_igual_silver", col("fato"), col("itens")),
        no_rows("sem_item_orfao_de_pedido", col("sem_pedido")),
        no_rows("sem_item_orfao_de_cliente", col("sem_cliente")),
        no_rows("data_compra_nao_nula", col("sem_data")),
        no_rows("nota_avaliacao_entre_1_e_5", col("notas_ruins")),
        volume("volume_fato_vendas", col("linhas"), *fact_volume),
        same_amount("mart_categoria_soma_igual_fato", col("categorias"), col("fato_valido")),
        same_amount("mart_vendas_mensal_soma_igual_fato", col("meses"), col("fato_valido")),
        no_rows("cep_prefixo_5_digitos_dim_geografia", col("ceps_ruins")),
    ]
    return rows_of(numbers, checks).orderBy("teste")


def key_report(
    tables: dict[str, tuple[DataFrame, tuple[str, ...]]], totals: DataFrame | None = None
) -> DataFrame:
    """Uniqueness of each table's grain: ``{name: (table, key columns)}``.

    The stored ``order_totals`` of the fact have counted its repeated items already.
    """
    counts = [
        duplicate_count(df, keys).withColumnRenamed("n", name) for name, (df, keys) in tables.items()
    ]
    if totals is not None:
        repeated = F.coalesce(F.sum("itens_repetidos"), F.lit(0))
        counts.append(totals.agg(repeated.alias("fato_vendas")))
        tables = {**tables, "fato_vendas": (totals, ())}
    checks = [no_rows(f"chave_unica_{name}", F.col(name)) for name in tables]
    return rows_of(beside(*counts), checks).orderBy("teste")
