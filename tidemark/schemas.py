"""Raw file layouts and table names.

The names below are fixed values: they are the column and table names of the data contract,
so existing queries keep working. Every raw column is a string.
"""

from __future__ import annotations

from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

# Raw column names (spelling as in the files).
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "customers": (
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ),
    "geolocation": (
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    ),
    "orders": (
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ),
    "order_items": (
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ),
    "order_payments": (
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    ),
    "order_reviews": (
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    ),
    "products": (
        "product_id",
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ),
    "sellers": (
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
    ),
    "product_category_translation": (
        "product_category_name",
        "product_category_name_english",
    ),
}

ARRIVAL_LOG = StructType(
    [
        StructField("tabela", StringType()),
        StructField("arquivo", StringType()),
        StructField("bytes", LongType()),
        StructField("linhas", LongType()),
        StructField("conferido_em", TimestampType()),
    ]
)


def raw_schema(table: str) -> StructType:
    """All-string schema of one raw table."""
    return StructType([StructField(name, StringType()) for name in RAW_COLUMNS[table]])


def manifest(pattern: str = "{table}.csv", overrides: dict[str, str] | None = None) -> dict[str, str]:
    """``{table: landing name}`` for the nine expected drops.

    A landing name is a file, or a folder of part files, directly below the landing folder.
    """
    names = {table: pattern.format(table=table) for table in RAW_COLUMNS}
    names.update(overrides or {})
    return names
