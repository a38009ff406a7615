"""Consumption marts over the sales fact; cancelled orders (and unknown flags) are left out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import mean_rounded, per_unit
from tidemark.operators.distinct import NUMBER, distinct_counts, distinct_sets, numbered

# Fixed value: the name the mart gives to products without a category.
UNCATEGORISED = "sem_categoria"
REVENUE = "decimal(29,2)"


def sold(fact: DataFrame) -> DataFrame:
    return fact.filter(~F.col("cancelado"))


ORDER_VALUES = ("cliente_id", "data_compra", "cancelado", "metodo_pagamento_principal", "valor_pago")


def order_totals(
    fact: DataFrame, values: tuple[str, ...] = ORDER_VALUES, repeats: bool = False
) -> DataFrame:
    """The fact at order grain, cancelled orders included: one row per order, far smaller.

    Order-level values repeat on every item, so they are group keys, and a report that is computed once names
    those it needs: what makes the others is then not read. Averages over items keep their sums and counts.
    ``repeats``, for totals that are kept, adds ``itens_repetidos``: items beyond the first of their number.
    """
    repeated = F.count(F.lit(1)) - F.count_distinct("item_id") - F.max(F.col("item_id").isNull().cast("int"))
    return fact.groupBy("pedido_id", *values).agg(
        F.count(F.lit(1)).alias("itens"),
        *([repeated.alias("itens_repetidos")] if repeats else []),
        F.sum("receita").alias("receita"),
        F.sum("nota_avaliacao").alias("nota_soma"),
        F.count("nota_avaliacao").alias("nota_n"),
        F.sum("tempo_entrega_dias").alias("tempo_soma"),
        F.count("tempo_entrega_dias").alias("tempo_n"),
        F.sum("atraso_dias").alias("atraso_soma"),
        F.count("atraso_dias").alias("atraso_n"),
    )


def monthly_sales(totals: DataFrame) -> DataFrame:
    """By year and month of purchase, from ``order_totals``."""
    orders, revenue = F.count(F.lit(1)), F.sum("receita").cast(REVENUE)
    return (
        sold(totals)
        .groupBy(F.year("data_compra").alias("ano"), F.month("data_compra").alias("mes"))
        .agg(
            orders.alias("total_pedidos"),
            revenue.alias("receita"),
            per_unit(revenue, orders).alias("ticket_medio"),
            mean_rounded(F.sum("tempo_soma"), F.sum("tempo_n"), 1).alias("tempo_entrega_medio_dias"),
        )
    )


def category_performance(fact: DataFrame, products: DataFrame, sets: DataFrame | None = None) -> DataFrame:
    """By category. An order can mix products of one category, so its orders are counted after
    the join; a product that sells far more than the others is a skewed join partition.

    ``sets`` are the stored ``order_sets`` of the same fact and products: the orders are counted in them, and the lines
    move once, to meet their category, instead of once more to meet the other lines of their order.
    """
    category = products.select(F.col("product_id").alias("produto_id"), "categoria_en")
    lines = sold(fact).join(category, "produto_id", "left")
    by_category = lines.groupBy(F.coalesce("categoria_en", F.lit(UNCATEGORISED)).alias("categoria_en"))
    sold_items = F.count(F.lit(1)).alias("itens_vendidos")
    sums = F.sum("receita").alias("receita"), F.round(F.avg("nota_avaliacao"), 2).alias("nota_media")
    if sets is None:
        return by_category.agg(sold_items, F.count_distinct("pedido_id").alias("pedidos"), *sums)
    orders = distinct_counts(sets, "categoria_en", name="pedidos")
    columns = ("categoria_en", "itens_vendidos", F.coalesce("pedidos", F.lit(0).cast("long")).alias("pedidos"), "receita", "nota_media")
    return by_category.agg(sold_items, *sums).join(orders, "categoria_en", "left").select(*columns)


def seller_performance(fact: DataFrame, sellers: DataFrame) -> DataFrame:
    """By seller. Aggregated before the join: only one row per seller meets the dimension."""
    totals = (
        sold(fact)
        .groupBy("vendedor_id")
        .agg(
            F.count(F.lit(1)).alias("itens_vendidos"),
            F.count_distinct("pedido_id").alias("pedidos"),
            F.sum("receita").alias("receita"),
            F.round(F.avg("atraso_dias"), 1).alias("atraso_medio_dias"),
            F.round(F.avg("nota_avaliacao"), 2).alias("nota_media"),
        )
    )
    place = sellers.select(F.col("seller_id").alias("vendedor_id"), "cidade", "uf")
    return totals.join(place, "vendedor_id", "left").select(
        "vendedor_id",
        "cidade",
        "uf",
        "itens_vendidos",
        "pedidos",
        "receita",
        "atraso_medio_dias",
        "nota_media",
    )


def person_totals(totals: DataFrame) -> DataFrame:
    """Per person, from ``order_totals``: orders, revenue and the sums behind the averages.

    An order belongs to one person, so distinct orders add up over persons. Reports that count
    both persons and orders build on this and never expand the fact once per distinct count.
    """
    sums = ("nota_soma", "nota_n", "tempo_soma", "tempo_n", "atraso_soma", "atraso_n")
    return (
        sold(totals)
        .groupBy("cliente_id")
        .agg(
            F.count(F.lit(1)).alias("pedidos"),
            F.sum("receita").cast(REVENUE).alias("receita"),
            *(F.sum(c).alias(c) for c in sums),
        )
    )


def geography_sales(persons_sold: DataFrame, persons: DataFrame) -> DataFrame:
    """By the state of the person's latest address (not the address of each order), from
    ``person_totals``."""
    home = persons.select(F.col("customer_unique_id").alias("cliente_id"), "uf")
    return (
        persons_sold.join(home, "cliente_id")
        .groupBy("uf")
        .agg(
            F.count(F.lit(1)).alias("clientes_unicos"),
            F.sum("pedidos").alias("pedidos"),
            F.sum("receita").cast(REVENUE).alias("receita"),
        )
    )


# Distinct counts that add up over months: sets of dense numbers, see ``operators.distinct``.


def person_numbers(persons: DataFrame) -> DataFrame:
    """``(cliente_id, uf, numero)``: persons of a state have neighbouring numbers."""
    numbers = numbered(persons, "customer_unique_id", near="uf")
    return persons.join(numbers, "customer_unique_id").select(
        F.col("customer_unique_id").alias("cliente_id"), "uf", NUMBER
    )


def order_numbers(totals: DataFrame) -> DataFrame:
    """``(pedido_id, numero)``: orders of a month have neighbouring numbers."""
    return numbered(totals, "pedido_id", near="ano_mes")


def person_sets(totals: DataFrame, numbers: DataFrame) -> DataFrame:
    """Who bought in each month, by the state of the person's latest address; cancelled orders left out."""
    bought = sold(totals).select("ano_mes", "cliente_id").join(numbers, "cliente_id")
    return distinct_sets(bought, "ano_mes", "uf")


def order_sets(fact: DataFrame, products: DataFrame, numbers: DataFrame) -> DataFrame:
    """The orders of each month by category, cancelled ones left out; an order can be in several categories.

    Products of an order count once and get its number first. That moves nothing where both tables are stored in buckets
    of the order, and what is moved to meet the categories is short.
    """
    lines = sold(fact).select("ano_mes", "pedido_id", "produto_id").distinct()
    lines = lines.join(numbers.hint("merge"), "pedido_id").select("ano_mes", NUMBER, "produto_id")
    category = products.select(F.col("product_id").alias("produto_id"), "categoria_en")
    named = lines.join(category, "produto_id", "left")
    named = named.withColumn("categoria_en", F.coalesce("categoria_en", F.lit(UNCATEGORISED)))
    return distinct_sets(named, "ano_mes", "categoria_en", repeats=False)
