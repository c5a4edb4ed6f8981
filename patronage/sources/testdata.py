"""Adapter: the driver's TPC-H-ish parquet → the nine canonical source tables.

The driver tables have no payments, reviews or delivery dates, so those are
derived by integer arithmetic on the order key ``k`` (FIXTURES.md §3). Every
rule is a column expression, so the adapter is a projection/explode of the
scans: it grows with the data and runs fully distributed. Keys stay BIGINT
(cheaper to hash and shuffle than strings).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.functions.columns import add_days
from patronage.plans.joins import with_one_row

TPCH_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read_tpch(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def canonical_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The nine canonical raw tables (geolocation: one row per nation as a zip prefix)."""
    o = read_tpch(spark, sf_dir, "orders")
    li = read_tpch(spark, sf_dir, "lineitem")
    cust = read_tpch(spark, sf_dir, "customer")
    nation = read_tpch(spark, sf_dir, "nation")
    part = read_tpch(spark, sf_dir, "part")
    supp = read_tpch(spark, sf_dir, "supplier")

    k = F.col("o_orderkey")
    ts = F.col("o_orderdate")

    orders = o.select(
        k.alias("order_id"),
        k.alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        ts.alias("order_purchase_timestamp"),
        F.lit(None).cast("timestamp_ntz").alias("order_approved_at"),
        F.lit(None).cast("timestamp_ntz").alias("order_delivered_carrier_date"),
        F.when(k % 40 == 0, add_days(ts, -1))
         .when(k % 20 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(add_days(ts, (k % 37 + 3).cast("int")))
         .alias("order_delivered_customer_date"),
        add_days(ts, 30).alias("order_estimated_delivery_date"),
    )

    # nation is a fixed 25-row dimension: broadcasting it is bounded by construction.
    nat = F.broadcast(nation.select("n_nationkey", "n_name"))
    customers = (
        o.select(k.alias("customer_id"), F.col("o_custkey"))
        .join(cust.select("c_custkey", "c_nationkey", "c_mktsegment"),
              F.col("o_custkey") == F.col("c_custkey"), "inner")
        .join(nat, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select("customer_id",
                F.col("o_custkey").alias("customer_unique_id"),
                F.col("c_nationkey").alias("customer_zip_code_prefix"),
                F.col("c_mktsegment").alias("customer_city"),
                F.col("n_name").alias("customer_state"))
    )

    items = li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("short").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        (F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
    )

    split = k % 7 == 0
    payments = o.select(
        k.alias("order_id"),
        F.explode(F.when(split, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
         .alias("payment_sequential"),
        F.col("o_orderpriority").alias("payment_type"),
        (k % 10 + 1).cast("short").alias("payment_installments"),
        F.when(split, F.col("o_totalprice") / 2).otherwise(F.col("o_totalprice")).alias("payment_value"),
    ).withColumn("payment_sequential", F.col("payment_sequential").cast("short"))

    first_created = add_days(ts, (k % 45 + 5).cast("int"))
    second = k % 11 == 0
    reviews = (
        o.where(k % 10 != 0)
        .select(k, ts,
                F.explode(F.when(second, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
                .alias("seq"))
        .select(
            F.concat_ws("-", F.col("o_orderkey").cast("string"), F.col("seq").cast("string")).alias("review_id"),
            k.alias("order_id"),
            F.when(F.col("seq") == 1, k % 5 + 1).otherwise((k + 2) % 5 + 1).cast("byte").alias("review_score"),
            F.when(F.col("seq") == 1, first_created).otherwise(add_days(first_created, 3))
             .alias("review_creation_date"),
        )
        .withColumn("review_answer_timestamp", add_days("review_creation_date", 1))
    )

    products = part.select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 50 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("p_type")).alias("product_category_name"),
    )

    # All part types but the greatest one get an English name (the other keeps
    # the untranslated path exercised). The type domain is tiny; the max is a
    # one-row aggregate.
    types = part.select(F.col("p_type").alias("product_category_name")).distinct()
    top = part.agg(F.max("p_type").alias("__max"))
    translation = (
        with_one_row(types, top)
        .where(F.col("product_category_name") < F.col("__max"))
        .select("product_category_name",
                F.lower("product_category_name").alias("product_category_name_english"))
    )

    sellers = (
        supp.select("s_suppkey", "s_nationkey")
        .join(nat, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select(F.col("s_suppkey").alias("seller_id"),
                F.col("s_nationkey").alias("seller_zip_code_prefix"),
                F.col("n_name").alias("seller_state"))
    )

    geolocation = nation.select(
        F.col("n_nationkey").alias("geolocation_zip_code_prefix"),
        F.lit(None).cast("double").alias("geolocation_lat"),
        F.lit(None).cast("double").alias("geolocation_lng"),
        F.col("n_name").alias("geolocation_city"),
        F.col("n_name").alias("geolocation_state"),
    )

    return {
        "customers": customers, "orders": orders, "order_items": items,
        "order_payments": payments, "order_reviews": reviews, "products": products,
        "sellers": sellers, "category_translation": translation, "geolocation": geolocation,
    }


def purchase_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-like view of ``events``: purchases with intraday timestamps.

    Shaped like the orders mart's key columns so gap/occasion operators
    (AGG13, AGG15, WIN2, FEA5) can run on sub-day gaps that ``orders`` lacks.
    """
    ev = read_tpch(spark, sf_dir, "events")
    return (ev.where(F.col("event_type") == "purchase")
            .select(F.col("event_id").alias("order_id"),
                    F.col("user_id").alias("customer_unique_id"),
                    F.col("ts").alias("order_purchase_timestamp"),
                    F.col("value").alias("order_revenue")))
