"""Business metrics, one function per view.

Each is a SQL text over named inputs, so that the same text gives a frame over any input and the
body of a published view over the published tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.plans.marts import REVENUE

# Fixed value: the name of a missing payment method.
UNKNOWN_METHOD = "nao_informado"

# One row of headline numbers for orders that were not cancelled, over ``person_totals``.
KPI_SNAPSHOT = f"""
SELECT coalesce(sum(pedidos), 0) AS total_pedidos,
       count(cliente_id) AS total_clientes,
       cast(sum(receita) AS {REVENUE}) AS gmv,
       round(cast(sum(receita) AS {REVENUE}) / nullif(sum(pedidos), 0), 2) AS ticket_medio,
       round(cast(sum(nota_soma) AS double) / nullif(sum(nota_n), 0), 2) AS nota_media,
       round(cast(sum(tempo_soma) AS double) / nullif(sum(tempo_n), 0), 1) AS tempo_entrega_medio_dias,
       round(cast(sum(atraso_soma) AS double) / nullif(sum(atraso_n), 0), 1) AS atraso_medio_dias
FROM {{rows}}"""

# Per year and month, at order grain.
CANCELLATION_RATE = """
SELECT year(data_compra) AS ano, month(data_compra) AS mes,
       count(1) AS total_pedidos,
       count_if(cancelado) AS pedidos_cancelados,
       round(100.0 * count_if(cancelado) / count(1), 2) AS taxa_cancelamento_pct
FROM (SELECT DISTINCT {order_id}, data_compra, cancelado FROM {rows})
GROUP BY year(data_compra), month(data_compra)"""

# Orders and amount paid per main method.
PAYMENT_MIX = f"""
SELECT coalesce(metodo_pagamento_principal, '{UNKNOWN_METHOD}') AS metodo_pagamento,
       count(1) AS total_pedidos,
       sum(valor_pago) AS valor_total_pago
FROM (SELECT DISTINCT {{dedup}} FROM {{rows}} WHERE NOT cancelado)
GROUP BY coalesce(metodo_pagamento_principal, '{UNKNOWN_METHOD}')"""

# The categories with most revenue; ties go by name.
TOP_CATEGORIES = """
SELECT categoria_en, itens_vendidos, pedidos, receita, nota_media FROM {rows}
ORDER BY receita DESC NULLS LAST, categoria_en LIMIT {n}"""

PER_ORDER = ("pedido_id", "metodo_pagamento_principal", "valor_pago")
PER_ITEM_VALUE = ("pedido_id", "receita", "metodo_pagamento_principal", "valor_pago")

# name of the view -> its text and the published table it reads
VIEWS: dict[str, tuple[str, str]] = {
    "vw_metricas_gerais": (KPI_SNAPSHOT, "pessoa_totais"),
    "vw_taxa_cancelamento": (CANCELLATION_RATE.replace("{order_id}", "pedido_id"), "pedido_totais"),
    "vw_metodo_pagamento": (PAYMENT_MIX.replace("{dedup}", ", ".join(PER_ITEM_VALUE)), "fato_vendas"),
    "vw_metodo_pagamento_por_pedido": (
        PAYMENT_MIX.replace("{dedup}", ", ".join(PER_ORDER)),
        "pedido_totais",
    ),
    "vw_top10_categorias": (TOP_CATEGORIES.replace("{n}", "10"), "mart_categoria_performance"),
}


def over(rows: DataFrame, text: str) -> DataFrame:
    return rows.sparkSession.sql(text, rows=rows)


def kpi_snapshot(persons_sold: DataFrame) -> DataFrame:
    """Headline numbers from ``person_totals``."""
    return over(persons_sold, KPI_SNAPSHOT)


def cancellation_rate(orders: DataFrame, order_id: str = "pedido_id") -> DataFrame:
    """Over ``order_totals`` or the fact, orders without items are missing (the view's definition);
    pass the silver orders and ``order_id="order_id"`` to count them too.
    """
    return over(orders, CANCELLATION_RATE.replace("{order_id}", order_id))


def payment_mix(rows: DataFrame, dedup: tuple[str, ...] = PER_ORDER) -> DataFrame:
    """``PER_ORDER``, over ``order_totals`` or the fact, counts every order once. ``PER_ITEM_VALUE``,
    over the fact, keeps one row per order and distinct item value, which repeats the payment of
    orders with several different items.
    """
    return over(rows, PAYMENT_MIX.replace("{dedup}", ", ".join(dedup)))


def top_categories(categories: DataFrame, n: int = 10) -> DataFrame:
    return over(categories, TOP_CATEGORIES.replace("{n}", str(int(n))))
