"""Declared schemas of the nine source tables (keys, required columns, FKs).

Fully declared: no schema inference on read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    name: str
    filename: str
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    foreign_keys: tuple[tuple[str, str, str], ...] = ()   # (column, parent table, parent column)
    date_columns: tuple[str, ...] = ()
    line_breaks: bool = False   # texts may hold them, so a file can't be split


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, TS, D, SH, I, B = T.StringType(), T.TimestampNTZType(), T.DoubleType(), T.ShortType(), T.IntegerType(), T.ByteType()

CUSTOMERS = TableSpec(
    "customers", "olist_customers_dataset.csv",
    _s(("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", I),
       ("customer_city", S), ("customer_state", S)),
    primary_key=("customer_id",), required=("customer_id", "customer_unique_id"))

ORDERS = TableSpec(
    "orders", "olist_orders_dataset.csv",
    _s(("order_id", S), ("customer_id", S), ("order_status", S),
       ("order_purchase_timestamp", TS), ("order_approved_at", TS),
       ("order_delivered_carrier_date", TS), ("order_delivered_customer_date", TS),
       ("order_estimated_delivery_date", TS)),
    primary_key=("order_id",),
    required=("order_id", "customer_id", "order_status", "order_purchase_timestamp"),
    foreign_keys=(("customer_id", "customers", "customer_id"),),
    date_columns=("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
                  "order_delivered_customer_date", "order_estimated_delivery_date"))

ORDER_ITEMS = TableSpec(
    "order_items", "olist_order_items_dataset.csv",
    _s(("order_id", S), ("order_item_id", SH), ("product_id", S), ("seller_id", S),
       ("shipping_limit_date", TS), ("price", D), ("freight_value", D)),
    primary_key=("order_id", "order_item_id"),
    required=("order_id", "order_item_id", "product_id", "seller_id", "price"),
    foreign_keys=(("order_id", "orders", "order_id"), ("product_id", "products", "product_id"),
                  ("seller_id", "sellers", "seller_id")),
    date_columns=("shipping_limit_date",))

ORDER_PAYMENTS = TableSpec(
    "order_payments", "olist_order_payments_dataset.csv",
    _s(("order_id", S), ("payment_sequential", SH), ("payment_type", S),
       ("payment_installments", SH), ("payment_value", D)),
    primary_key=("order_id", "payment_sequential"),
    required=("order_id", "payment_sequential", "payment_type", "payment_value"),
    foreign_keys=(("order_id", "orders", "order_id"),))

ORDER_REVIEWS = TableSpec(
    "order_reviews", "olist_order_reviews_dataset.csv",
    _s(("review_id", S), ("order_id", S), ("review_score", B),
       ("review_creation_date", TS), ("review_answer_timestamp", TS)),
    required=("review_id", "order_id", "review_score"),
    foreign_keys=(("order_id", "orders", "order_id"),),
    date_columns=("review_creation_date", "review_answer_timestamp"), line_breaks=True)

PRODUCTS = TableSpec(
    "products", "olist_products_dataset.csv",
    _s(("product_id", S), ("product_category_name", S)),
    primary_key=("product_id",), required=("product_id",))

SELLERS = TableSpec(
    "sellers", "olist_sellers_dataset.csv",
    _s(("seller_id", S), ("seller_zip_code_prefix", I), ("seller_state", S)),
    primary_key=("seller_id",), required=("seller_id",))

CATEGORY_TRANSLATION = TableSpec(
    "category_translation", "product_category_name_translation.csv",
    _s(("product_category_name", S), ("product_category_name_english", S)),
    primary_key=("product_category_name",),
    required=("product_category_name", "product_category_name_english"))

GEOLOCATION = TableSpec(
    "geolocation", "olist_geolocation_dataset.csv",
    _s(("geolocation_zip_code_prefix", I), ("geolocation_lat", D), ("geolocation_lng", D),
       ("geolocation_city", S), ("geolocation_state", S)),
    required=("geolocation_zip_code_prefix",))

# Parents before children.
TABLES = (CUSTOMERS, ORDERS, ORDER_ITEMS, ORDER_PAYMENTS, ORDER_REVIEWS, PRODUCTS, SELLERS,
          CATEGORY_TRANSLATION, GEOLOCATION)
TABLES_BY_NAME = {t.name: t for t in TABLES}
