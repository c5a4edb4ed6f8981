"""Order-line and order marts (JOI1-JOI8, AGG1, AGG3, FIL9-FIL11).

Join order is chosen for co-partitioning: everything keyed by ``order_id``
(items, orders, collapsed reviews, aggregated payments) meets on one
``order_id`` partitioning; the customer attributes are attached to orders
before that, on ``customer_id``; products and sellers are dimensions joined
behind a size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.config import CUSTOMER_KEY
from patronage.functions.columns import days_between, month_start, null_safe_gt
from patronage.operators.clean import Ledger, clean_all, ledger_after, observed
from patronage.plans.joins import dimension_join, parts_of
from patronage.session import materialize

TRANSACTION_COLUMNS = (
    "order_id", "order_item_id", CUSTOMER_KEY, "customer_id",
    "order_purchase_timestamp", "order_date", "order_month", "order_status",
    "product_id", "product_category", "seller_id", "seller_state",
    "price", "freight_value", "item_revenue",
    "customer_city", "customer_state",
    "review_score", "payment_type", "max_installments", "n_payment_methods",
    "payment_total", "delivery_days", "delivered_late",
    "order_delivered_customer_date", "review_creation_date",
)


def aggregate_payments(payments: DataFrame) -> DataFrame:
    """AGG1: one row per order; mode ties → smallest payment type."""
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("payment_total"),
        F.count(F.lit(1)).alias("n_payment_methods"),
        F.max("payment_installments").alias("max_installments"),
        F.mode("payment_type", True).alias("payment_type"),
    )


def build_transactions(clean: dict[str, DataFrame], ledger: Ledger | None = None) -> DataFrame:
    """The order lines with everything known about them. With a ledger the mart
    is written and the two steps that lose rows are observed on the way: no join
    after the first drops or adds rows, so both are counted in the stage that writes."""
    items = clean["order_items"]
    orders = clean["orders"].select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_delivered_customer_date", "order_estimated_delivery_date")
    customers = clean["customers"].select("customer_id", CUSTOMER_KEY, "customer_city", "customer_state")
    # The side with a row per order says into how many parts the joins by order are dealt out
    # (an order has at most as many lines as a short has values, so no part is large).
    reviews = clean["order_reviews"].select("order_id", "review_score", "review_creation_date")
    parts = parts_of(reviews)
    reviews = reviews.repartition(parts, "order_id")
    # Payments of orders that were dropped reach no line: they are not added up.
    kept = orders.select("order_id").repartition(parts, "order_id")
    pay = aggregate_payments(clean["order_payments"].join(kept, "order_id", "left_semi"))
    products = clean["products"].select("product_id", "product_category")
    sellers = clean["sellers"].select("seller_id", "seller_state")

    # JOI2: orders with no matching customer vanish (with a ledger below; a clean customer's
    # key is never null). Orders get their customer before they meet the lines, which are so
    # moved once, by order. JOI1: items of filtered-out orders vanish.
    bought = orders.join(customers, "customer_id", "left" if ledger else "inner").repartition(parts, "order_id")
    tx = items.join(bought, "order_id", "inner")
    # JOI5/JOI6: 1:1 by construction (collapsed / aggregated per order).
    tx = tx.join(reviews, "order_id", "left").join(pay, "order_id", "left")
    # JOI3/JOI4: descriptive dimensions; unmatched products fall back to 'unknown'.
    tx = dimension_join(tx, products, "product_id", "left")
    tx = dimension_join(tx, sellers, "seller_id", "left")

    ts = F.col("order_purchase_timestamp")
    tx = tx.withColumns({
        "product_category": F.coalesce(F.col("product_category"), F.lit("unknown")),
        "item_revenue": F.col("price") + F.col("freight_value"),
        "order_month": month_start(ts),
        "order_date": F.to_date(ts),
        "delivery_days": days_between(ts, "order_delivered_customer_date"),
        "delivered_late": null_safe_gt("order_delivered_customer_date", "order_estimated_delivery_date"),
    }).select(*TRANSACTION_COLUMNS)
    if ledger is None:
        return tx
    known = F.col(CUSTOMER_KEY).isNotNull()
    tx, counts = observed(tx, ordered=F.count(F.lit(1)), known=F.count_if(known))
    out = materialize(tx.where(known))
    n, lines = counts(), ledger_after(ledger, 303)
    ledger.add(800, "transactions", "items whose order was filtered out", lines, n["ordered"])
    ledger.add(801, "transactions", "orders with no matching customer", n["ordered"], n["known"])
    return out


def build_orders(tx: DataFrame) -> DataFrame:
    """AGG3: one row per order. Order-level attributes are constant within an
    order, so ``max`` returns that constant (deterministic). Lines are moved once, by
    order, into parts of bounded size; all sums and distinct counts follow there."""
    const = ["customer_unique_id", "customer_id", "order_purchase_timestamp", "order_date", "order_month",
             "payment_total", "payment_type", "max_installments", "review_score", "delivery_days",
             "delivered_late", "order_delivered_customer_date", "review_creation_date",
             "customer_state", "customer_city"]
    agg = tx.repartition(parts_of(tx), "order_id").groupBy("order_id").agg(
        *[F.max(c).alias(c) for c in const],
        F.count(F.lit(1)).alias("n_items"),
        F.size(F.collect_set("product_id")).cast("long").alias("n_distinct_products"),
        F.size(F.collect_set("seller_id")).cast("long").alias("n_sellers"),
        F.sum("price").alias("product_revenue"),
        F.sum("freight_value").alias("freight"),
        F.sum("item_revenue").alias("order_revenue"),
        F.mode("product_category", True).alias("top_category"),
    )
    return agg.select(
        "order_id", CUSTOMER_KEY, "customer_id", "order_purchase_timestamp", "order_date", "order_month",
        "n_items", "n_distinct_products", "n_sellers", "product_revenue", "freight", "order_revenue",
        "payment_total", "payment_type", "max_installments", "review_score", "delivery_days", "delivered_late",
        "order_delivered_customer_date", "review_creation_date", "customer_state", "customer_city",
        "top_category")


def build_marts(raw: dict[str, DataFrame], params, ledger: Ledger | None = None):
    """Clean → transactions → orders, all written. Returns (clean tables, transactions, orders, ledger)."""
    clean, ledger = clean_all(raw, params, ledger)
    tx = build_transactions(clean, ledger)
    return clean, tx, materialize(build_orders(tx)), ledger
