"""Dimensions and the item-grain sales fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import HOT_ROWS, spread_join
from tidemark.operators.spine import PEAK_MONTHS, calendar_spine


def person_dimension(
    customers: DataFrame, orders: DataFrame, items: DataFrame, as_of: Column | None = None
) -> DataFrame:
    """One row per person: order history over all their order-level ids, and latest address.

    Orders count cancelled ones too; revenue and purchase dates do not. The latest address comes
    from the same aggregation (greatest purchase date, then order id) instead of a second pass.
    Items are summed per order before the join, so nothing of item grain is joined, and the
    grouping by person combines map-side, so a person with very many orders does not pile up.
    """
    revenue = items.groupBy("order_id").agg(F.sum("valor_item").alias("valor_pedido"))
    visits = (
        customers.select("customer_id", "customer_unique_id", "cidade", "uf", "cep_prefixo")
        .join(orders.select("customer_id", "order_id", "data_compra", "cancelado"), "customer_id")
        .join(revenue, "order_id", "left")
    )
    kept = ~F.col("cancelado")
    address = F.struct("cidade", "uf", "cep_prefixo")
    history = visits.groupBy("customer_unique_id").agg(
        F.max_by(address, F.struct("data_compra", "order_id", address)).alias("endereco"),
        F.min(F.when(kept, F.col("data_compra"))).alias("data_primeiro_pedido"),
        F.max(F.when(kept, F.col("data_compra"))).alias("data_ultimo_pedido"),
        F.count_distinct("order_id").alias("total_pedidos"),
        F.sum(F.when(kept, F.coalesce("valor_pedido", F.lit(0))).otherwise(F.lit(0))).alias(
            "receita_acumulada"
        ),
    )
    today = F.current_date() if as_of is None else as_of
    return history.filter(F.col("customer_unique_id").isNotNull()).select(
        "customer_unique_id",
        "endereco.cidade",
        "endereco.uf",
        "endereco.cep_prefixo",
        "data_primeiro_pedido",
        "data_ultimo_pedido",
        "total_pedidos",
        "receita_acumulada",
        F.datediff(today, "data_ultimo_pedido").alias("dias_sem_comprar"),
    )


def product_dimension(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id",
        "categoria",
        "categoria_en",
        "peso_g",
        "comprimento_cm",
        "altura_cm",
        "largura_cm",
        "qtd_fotos",
    )


def seller_dimension(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", "cep_prefixo", "cidade", "uf")


def geography_dimension(geolocation: DataFrame) -> DataFrame:
    return geolocation.select("cep_prefixo", "cidade", "uf", "latitude", "longitude")


def calendar_dimension(orders: DataFrame, peak_months=PEAK_MONTHS) -> DataFrame:
    return calendar_spine(orders, "data_compra", peak_months)


def payment_per_order(payments: DataFrame) -> DataFrame:
    """Amount paid and the method with the lowest sequence (rows without a sequence never win)."""
    rank = F.when(F.col("sequencial").isNotNull(), F.struct("sequencial", "tipo_pagamento"))
    return payments.groupBy("order_id").agg(
        F.sum("valor_pagamento").alias("valor_pago"),
        F.min_by("tipo_pagamento", rank).alias("metodo_pagamento_principal"),
    )


def review_per_order(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(F.avg("nota").alias("nota_avaliacao"))


def order_persons(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """The person of every order; stored by order, it saves whoever joins by order a shuffle."""
    person = customers.select("customer_id", F.col("customer_unique_id").alias("cliente_id"))
    return orders.select("order_id", "customer_id").join(person, "customer_id").select("order_id", "cliente_id")


def sales_fact(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    hot: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    persons: DataFrame | None = None,
) -> DataFrame:
    """One row per order item; payment and review values are the order's, repeated per item.

    Everything of order grain is joined first, so the items, the biggest table, are shuffled once, or not at
    all where all tables are stored in buckets by order. ``hot`` names orders of so many items that
    they are split over several tasks; it comes from when the items were written. ``persons`` are the stored
    ``order_persons``; without them, customers are joined here.
    """
    if persons is None:
        person = customers.select("customer_id", F.col("customer_unique_id").alias("cliente_id"))
        known = orders.join(person, "customer_id")
    else:
        known = orders.join(persons, "order_id")
    order_level = (
        known
        .join(payment_per_order(payments), "order_id", "left")
        .join(review_per_order(reviews), "order_id", "left")
        .select(
            "order_id",
            "customer_id",
            "cliente_id",
            "data_compra",
            "status",
            "cancelado",
            "entregue",
            "tempo_entrega_dias",
            "atraso_dias",
            "valor_pago",
            "metodo_pagamento_principal",
            "nota_avaliacao",
        )
    )
    lines = items.select(
        "order_id", "item_id", "product_id", "seller_id", "preco", "frete", "valor_item"
    )
    sales = spread_join(lines, order_level, "order_id", hot=hot, hot_rows=hot_rows)
    return sales.select(
        F.col("order_id").alias("pedido_id"),
        "item_id",
        "customer_id",
        "cliente_id",
        F.col("product_id").alias("produto_id"),
        F.col("seller_id").alias("vendedor_id"),
        "data_compra",
        "status",
        "cancelado",
        "entregue",
        "tempo_entrega_dias",
        "atraso_dias",
        "preco",
        "frete",
        F.col("valor_item").alias("receita"),
        "valor_pago",
        "metodo_pagamento_principal",
        "nota_avaliacao",
    )
