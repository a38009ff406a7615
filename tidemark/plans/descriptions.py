"""What each table and the less obvious columns mean; stored with the tables."""

from __future__ import annotations

BRONZE = "Raw copy of {file}: every column as text, nothing cleaned."
QUARANTINE = "Rows of {table} whose amounts can't be read, as they came."
LOG = "Arrival log: size and record count of every landed file, per run."

TABLES: dict[str, str] = {
    "silver.clientes": "Customers, one row per order-level customer_id (not per person).",
    "silver.pedidos": "Orders with life-cycle dates and derived flags, one row per order.",
    "silver.produtos": "Products with native and English category.",
    "silver.vendedores": "Sellers.",
    "silver.itens_pedido": "Order items, one row per order and item number.",
    "silver.pagamentos": "Payments, one row per order and payment sequence.",
    "silver.avaliacoes": "Reviews, the latest answer per review_id.",
    "silver.geolocalizacao": "One mean point per zip prefix.",
    "silver.pedido_pessoa": "The person of every order whose customer is known.",
    "gold.dim_cliente": "One row per person, over all their order-level ids.",
    "gold.dim_produto": "One row per product.",
    "gold.dim_vendedor": "One row per seller.",
    "gold.dim_geografia": "One row per zip prefix.",
    "gold.dim_calendario": "One row per day between the first and last purchase.",
    "gold.fato_vendas": "Sales at item grain; payment and review values are the order's.",
    "gold.pedido_totais": "One row per order of the fact: its values and the sums over its items.",
    "gold.pessoa_totais": "One row per person: the sums over their orders, cancelled left out.",
    "gold.pessoa_numero": "A dense number for every person, by state.",
    "gold.pedido_numero": "A dense number for every order of the fact, by month.",
    "gold.pessoa_mes": "The set of persons who bought in a month, by state, as bitmaps; merge with bitmap_or_agg.",
    "gold.pedido_categoria_mes": "The set of orders of a month, by category, as bitmaps; merge with bitmap_or_agg.",
    "gold.mart_vendas_mensal": "Revenue, orders and ticket per month, cancelled orders left out.",
    "gold.mart_categoria_performance": "Revenue and volume per category, cancelled left out.",
    "gold.mart_vendedor_performance": "Revenue, volume and lateness per seller, cancelled left out.",
    "gold.mart_geografia": "Revenue, orders and persons per state of the latest address.",
    "gold.vw_metricas_gerais": "Headline numbers in one row, cancelled orders left out.",
    "gold.vw_taxa_cancelamento": "Cancellation rate per month at order grain.",
    "gold.vw_metodo_pagamento": "Payment methods per order and distinct item value.",
    "gold.vw_metodo_pagamento_por_pedido": "Payment methods, every order counted once.",
    "gold.vw_top10_categorias": "The ten categories with most revenue.",
}

COLUMNS: dict[str, dict[str, str]] = {
    "silver.clientes": {
        "customer_unique_id": "The person; repeats over their orders, so not a key here.",
        "cep_prefixo": "Five digits as text, zero-padded; never a number.",
    },
    "silver.pedidos": {
        "tempo_entrega_dias": "Days from purchase to delivery; NULL until delivered.",
        "atraso_dias": "Days past the estimate, zero or less when on time; NULL until delivered.",
    },
    "silver.produtos": {"categoria_en": "English name, or the native one without a translation."},
    "silver.itens_pedido": {"valor_item": "Price plus freight; sums to the order's value."},
    "silver.geolocalizacao": {"qtd_pontos_origem": "How many raw points the mean is made of."},
    "gold.dim_cliente": {
        "total_pedidos": "Distinct orders, cancelled ones included.",
        "data_ultimo_pedido": "Last purchase that was not cancelled.",
        "cidade": "From the most recent order's address.",
    },
    "gold.dim_calendario": {"mes_pico_varejo_br": "Peak months of Brazilian retail."},
    "gold.fato_vendas": {
        "receita": "Price plus freight of the item.",
        "valor_pago": "Whole payment of the order, repeated per item; do not sum over items.",
    },
}
