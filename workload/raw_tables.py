"""The nine all-string raw tables, derived from the provided tables (all rows, no sampling).

Values are made untidy on purpose (spaces, case, signs in codes, unreadable dates and numbers), so
that the cleaning rules have something to do. ``workload/oracles.py`` states the same for DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stamp(time: str) -> str:
    return f"date_format({time}, 'yyyy-MM-dd HH:mm:ss')"


def later(time: str, days: str, hours: int = 0) -> str:
    return stamp(f"{time} + make_dt_interval(cast({days} AS int), {hours})")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, as the real customer file has it."""
    people = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return (
        table(spark, sf_dir, "orders")
        .join(people, "o_custkey")
        .selectExpr(
            "cast(o_orderkey AS string) AS customer_id",
            "cast(o_custkey AS string) AS customer_unique_id",
            "' ' || (c_nationkey * 37 + o_orderkey % 7) || '-x ' AS customer_zip_code_prefix",
            "'  ' || o_orderpriority || ' ' || c_mktsegment AS customer_city",
            "' ' || lower(left(c_mktsegment, 2)) || ' ' AS customer_state",
        )
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey AS string) AS order_id",
        "cast(o_orderkey AS string) AS customer_id",
        """CASE o_orderstatus WHEN 'P' THEN 'canceled' WHEN 'F' THEN 'delivered'
           ELSE 'shipped' END AS order_status""",
        f"{stamp('o_orderdate')} AS order_purchase_timestamp",
        f"{later('o_orderdate', '0', 1)} AS order_approved_at",
        f"""CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE {later("o_orderdate", "o_orderkey % 3", 2)}
            END AS order_delivered_carrier_date""",
        f"""CASE WHEN o_orderstatus <> 'F' THEN NULL WHEN o_orderkey % 97 = 0 THEN 'unknown'
            ELSE {later("o_orderdate", "o_orderkey % 23", 5)} END AS order_delivered_customer_date""",
        f"{later('o_orderdate', '10 + o_orderkey % 5')} AS order_estimated_delivery_date",
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = "cast(l_extendedprice AS decimal(18,2))"
    freight = f"cast({price} * cast(l_tax AS decimal(4,2)) AS decimal(18,2))"
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey AS string) AS order_id",
        "cast(l_linenumber AS string) AS order_item_id",
        "cast(l_partkey AS string) AS product_id",
        "cast(l_suppkey AS string) AS seller_id",
        f"{stamp('l_shipdate')} AS shipping_limit_date",
        f"cast({price} AS string) AS price",
        f"cast({freight} AS string) AS freight_value",
    )


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per line item; every eleventh quantity lacks a readable sequence."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey AS string) AS order_id",
        """CASE WHEN cast(l_quantity AS int) % 11 = 0 THEN 'n/a'
           ELSE cast(l_linenumber AS string) END AS payment_sequential""",
        "l_returnflag AS payment_type",
        "cast(cast(l_quantity AS int) AS string) AS payment_installments",
        "cast(cast(l_extendedprice AS decimal(18,2)) AS string) AS payment_value",
    )


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as reviews: the same user and event type repeat one review id."""
    day = stamp("date_trunc('day', ts)")
    return table(spark, sf_dir, "events").selectExpr(
        "user_id || '-' || event_type AS review_id",
        "cast(event_id AS string) AS order_id",
        "cast(event_id % 5 + 1 AS string) AS review_score",
        "event_type AS review_comment_title",
        "props AS review_comment_message",
        f"{day} AS review_creation_date",
        f"CASE WHEN event_id % 13 = 0 THEN '' ELSE {stamp('ts')} END AS review_answer_timestamp",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey AS string) AS product_id",
        "CASE WHEN p_partkey % 31 <> 0 THEN p_type || ' ' || p_brand END AS product_category_name",
        "cast(length(p_name) AS string) AS product_name_lenght",
        "cast(length(p_name) * 10 AS string) AS product_description_lenght",
        """CASE WHEN p_size % 10 = 0 THEN 'many' ELSE cast(p_size % 6 AS string) END
           AS product_photos_qty""",
        "cast(p_size * 100 AS string) AS product_weight_g",
        "' ' || p_size || ' ' AS product_length_cm",
        """CASE WHEN p_size % 7 = 0 THEN '' ELSE cast(p_size + 1 AS string) END
           AS product_height_cm""",
        "cast(p_size + 2 AS string) AS product_width_cm",
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    return (
        table(spark, sf_dir, "supplier")
        .join(nations, "s_nationkey")
        .selectExpr(
            "cast(s_suppkey AS string) AS seller_id",
            "s_nationkey || '.' || s_suppkey AS seller_zip_code_prefix",
            "' ' || n_name || ' branch ' AS seller_city",
            "lower(left(n_name, 2)) AS seller_state",
        )
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "' ' || (c_custkey % 400) || ' ' AS geolocation_zip_code_prefix",
        """CASE WHEN c_custkey % 50 = 0 THEN 'n/a' ELSE cast(c_acctbal AS string) END
           AS geolocation_lat""",
        "cast(c_custkey % 180 - 90 AS string) AS geolocation_lng",
        "CASE WHEN c_custkey % 3 <> 0 THEN lower(c_mktsegment) || ' city' END AS geolocation_city",
        "lower(left(c_mktsegment, 2)) AS geolocation_state",
    )


def product_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names for the categories of part types of even length; the others stay untranslated."""
    kinds = table(spark, sf_dir, "part").select("p_type", "p_brand").distinct()
    return kinds.filter("length(p_type) % 2 = 0").selectExpr(
        "p_type || ' ' || p_brand AS product_category_name",
        "lower(p_type || ' ' || p_brand) || '_en' AS product_category_name_english",
    )


DERIVATIONS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "customers": customers,
    "geolocation": geolocation,
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "products": products,
    "sellers": sellers,
    "product_category_translation": product_category_translation,
}


class RawTables(dict):
    """``{name: DataFrame}``, each derived when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        self[name] = DERIVATIONS[name](self.spark, self.sf_dir)
        return self[name]


class FaultyRawTables(RawTables):
    """The same tables with one fault for every rule, so that each check has something to find."""

    def __missing__(self, name: str) -> DataFrame:
        good = DERIVATIONS[name](self.spark, self.sf_dir)
        self[name] = FAULTS[name](good) if name in FAULTS else good
        return self[name]


def changed(df: DataFrame, **columns: str) -> DataFrame:
    return df.selectExpr(*(f"{columns.get(c, c)} AS {c}" for c in df.columns))


def repeated(df: DataFrame, condition: str) -> DataFrame:
    return df.unionByName(df.filter(condition))


FAULTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customers": lambda df: repeated(
        changed(
            df,
            customer_state="CASE WHEN cast(customer_unique_id AS bigint) % 17 = 0 THEN ' x ' ELSE customer_state END",
            customer_zip_code_prefix="""CASE WHEN cast(customer_unique_id AS bigint) % 19 <> 0
                                        THEN customer_zip_code_prefix END""",
        ),
        "cast(customer_id AS bigint) % 23 = 0",
    ),
    "orders": lambda df: repeated(
        changed(
            df.filter("cast(order_id AS bigint) % 31 <> 0"),
            order_purchase_timestamp="""CASE WHEN cast(order_id AS bigint) % 29 = 0 THEN 'soon'
                                        ELSE order_purchase_timestamp END""",
        ),
        "cast(order_id AS bigint) % 41 = 0",
    ),
    "order_items": lambda df: changed(
        df,
        order_item_id="CASE WHEN cast(order_id AS bigint) % 43 = 0 THEN 'n/a' ELSE order_item_id END",
        price="CASE WHEN order_item_id = '3' AND cast(order_id AS bigint) % 5 = 0 THEN '-' || price ELSE price END",
    ),
    "order_reviews": lambda df: changed(
        df, review_score="CASE WHEN cast(order_id AS bigint) % 37 = 0 THEN '7' ELSE review_score END"
    ),
    "sellers": lambda df: repeated(
        changed(
            df,
            seller_zip_code_prefix="CASE WHEN cast(seller_id AS bigint) % 10 <> 0 THEN seller_zip_code_prefix END",
        ),
        "cast(seller_id AS bigint) % 3 = 0",
    ),
    "products": lambda df: repeated(df, "cast(product_id AS bigint) % 37 = 0"),
    "geolocation": lambda df: changed(
        df,
        geolocation_zip_code_prefix="""CASE WHEN trim(geolocation_zip_code_prefix) <> '7'
                                       THEN geolocation_zip_code_prefix END""",
    ),
}
