"""Raw strings to typed tables. Grain: see each docstring.

Each ``clean_*`` takes the raw table(s) and returns the business columns; ``audited`` adds lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    fixed_or_null,
    int_or_null,
    money,
    place_name,
    state_code,
    timestamp_or_null,
    zip_prefix,
)
from tidemark.operators.audit import with_audit
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.geo import mean_point_per_key


def clean_customers(raw: DataFrame) -> DataFrame:
    """One row per ``customer_id``, which is issued per order; the person is customer_unique_id."""
    return raw.select(
        "customer_id",
        "customer_unique_id",
        zip_prefix("customer_zip_code_prefix").alias("cep_prefixo"),
        place_name("customer_city").alias("cidade"),
        state_code("customer_state").alias("uf"),
    )


def clean_orders(raw: DataFrame) -> DataFrame:
    """One row per order: life-cycle timestamps, flags, delivery time and lateness in days."""
    typed = raw.select(
        "order_id",
        "customer_id",
        F.col("order_status").alias("status"),
        timestamp_or_null("order_purchase_timestamp").alias("data_compra"),
        timestamp_or_null("order_approved_at").alias("data_aprovacao"),
        timestamp_or_null("order_delivered_carrier_date").alias("data_envio_transportadora"),
        timestamp_or_null("order_delivered_customer_date").alias("data_entrega_cliente"),
        timestamp_or_null("order_estimated_delivery_date").alias("data_estimada_entrega"),
    )
    delivered = F.col("data_entrega_cliente")
    return typed.select(
        "order_id",
        "customer_id",
        "status",
        (F.col("status") == "canceled").alias("cancelado"),
        (F.col("status") == "delivered").alias("entregue"),
        "data_compra",
        "data_aprovacao",
        "data_envio_transportadora",
        "data_entrega_cliente",
        "data_estimada_entrega",
        F.datediff(delivered, "data_compra").alias("tempo_entrega_dias"),
        F.datediff(delivered, "data_estimada_entrega").alias("atraso_dias"),
        F.year("data_compra").alias("ano"),
        F.month("data_compra").alias("mes"),
    )


def clean_products(raw: DataFrame, translation: DataFrame) -> DataFrame:
    """One row per product; an untranslated category keeps its native name.

    No join hint: Spark broadcasts the translation when it measures it small, and otherwise
    splits a category that dominates the catalogue as a skewed join partition.
    """
    return raw.join(translation, "product_category_name", "left").select(
        "product_id",
        F.col("product_category_name").alias("categoria"),
        F.coalesce("product_category_name_english", "product_category_name").alias("categoria_en"),
        int_or_null("product_weight_g").alias("peso_g"),
        int_or_null("product_length_cm").alias("comprimento_cm"),
        int_or_null("product_height_cm").alias("altura_cm"),
        int_or_null("product_width_cm").alias("largura_cm"),
        int_or_null("product_photos_qty").alias("qtd_fotos"),
        int_or_null("product_name_lenght").alias("tamanho_nome_caracteres"),
        int_or_null("product_description_lenght").alias("tamanho_descricao_caracteres"),
    )


def clean_sellers(raw: DataFrame) -> DataFrame:
    """One row per seller."""
    return raw.select(
        "seller_id",
        zip_prefix("seller_zip_code_prefix").alias("cep_prefixo"),
        place_name("seller_city").alias("cidade"),
        state_code("seller_state").alias("uf"),
    )


def clean_items(raw: DataFrame) -> DataFrame:
    """One row per order item; amounts are cast strictly."""
    return raw.select(
        "order_id",
        int_or_null("order_item_id").alias("item_id"),
        "product_id",
        "seller_id",
        timestamp_or_null("shipping_limit_date").alias("data_limite_envio"),
        money("price").alias("preco"),
        money("freight_value").alias("frete"),
        (money("price") + money("freight_value")).alias("valor_item"),
    )


def clean_payments(raw: DataFrame) -> DataFrame:
    """One row per order and payment sequence."""
    return raw.select(
        "order_id",
        int_or_null("payment_sequential").alias("sequencial"),
        F.col("payment_type").alias("tipo_pagamento"),
        int_or_null("payment_installments").alias("parcelas"),
        money("payment_value").alias("valor_pagamento"),
    )


def clean_reviews(raw: DataFrame, keys: tuple[str, ...] = ("review_id",)) -> DataFrame:
    """One row per ``keys``: the latest answer; ties go to the later creation, then order and score."""
    typed = raw.select(
        "review_id",
        "order_id",
        int_or_null("review_score").alias("nota"),
        F.col("review_comment_title").alias("titulo_comentario"),
        F.col("review_comment_message").alias("mensagem_comentario"),
        timestamp_or_null("review_creation_date").alias("data_criacao"),
        timestamp_or_null("review_answer_timestamp").alias("data_resposta"),
    )
    tiebreak = ("data_criacao", "order_id", "nota", "titulo_comentario", "mensagem_comentario")
    return latest_per_key(typed, keys, "data_resposta", tiebreak)


def clean_geolocation(raw: DataFrame) -> DataFrame:
    """One mean point per zip prefix."""
    return mean_point_per_key(
        raw,
        zip_prefix("geolocation_zip_code_prefix"),
        fixed_or_null("geolocation_lat"),
        fixed_or_null("geolocation_lng"),
        place_name("geolocation_city"),
        state_code("geolocation_state"),
    )


# Silver table, the raw table it is counted against, and how it is made from the raw tables.
TABLES = {
    "clientes": ("customers", lambda raw: clean_customers(raw["customers"])),
    "pedidos": ("orders", lambda raw: clean_orders(raw["orders"])),
    "produtos": (
        "products",
        lambda raw: clean_products(raw["products"], raw["product_category_translation"]),
    ),
    "vendedores": ("sellers", lambda raw: clean_sellers(raw["sellers"])),
    "itens_pedido": ("order_items", lambda raw: clean_items(raw["order_items"])),
    "pagamentos": ("order_payments", lambda raw: clean_payments(raw["order_payments"])),
    "avaliacoes": ("order_reviews", lambda raw: clean_reviews(raw["order_reviews"])),
    "geolocalizacao": ("geolocation", lambda raw: clean_geolocation(raw["geolocation"])),
}


def silver_table(name: str, raw: dict[str, DataFrame]) -> DataFrame:
    """One silver table with its audit columns."""
    source, build = TABLES[name]
    return with_audit(build(raw), raw[source])


def silver_tables(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All eight silver tables, without audit columns."""
    return {name: build(raw) for name, (_, build) in TABLES.items()}
