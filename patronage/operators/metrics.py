"""Headline KPIs, monthly trend, category/state breakdowns (AGG4-AGG9, AGG30).

Per-customer first months are a partial aggregation joined back (AQE splits
a hot customer on the join) rather than a per-customer window, which would
put a hot customer's rows in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.config import CUSTOMER_KEY
from patronage.functions.columns import pct, safe_div
from patronage.plans.joins import with_one_row

TS = "order_purchase_timestamp"
KPI_NAMES = ("total_revenue", "n_orders", "n_customers", "aov", "repeat_purchase_rate",
             "revenue_per_customer", "avg_items_per_order", "avg_review_score", "late_delivery_rate")


def headline_metrics(orders: DataFrame) -> DataFrame:
    """AGG4: one row of nine KPIs over the given slice; all 0 on empty input."""
    per_cust = orders.groupBy(CUSTOMER_KEY).agg(F.count_distinct(F.to_date(TS)).alias("occ"))
    cust = per_cust.agg(F.count(F.lit(1)).alias("n_customers"),
                        F.avg(F.when(F.col("occ") > 1, 100.0).otherwise(0.0)).alias("repeat_purchase_rate"))
    o = orders.agg(
        F.sum("order_revenue").alias("total_revenue"),
        F.count(F.lit(1)).alias("n_orders"),
        F.avg("order_revenue").alias("aov"),
        F.avg("n_items").alias("avg_items_per_order"),
        F.avg("review_score").alias("avg_review_score"),
        (F.avg(F.col("delivered_late").cast("double")) * 100.0).alias("late_delivery_rate"),
    )
    one = with_one_row(o, cust).withColumn("revenue_per_customer", safe_div("total_revenue", "n_customers"))
    empty = F.col("n_orders") == 0
    cols = []
    for n in KPI_NAMES:
        c = F.col(n)
        if n in ("n_orders", "n_customers"):
            cols.append(c.cast("long").alias(n))
        else:
            cols.append(F.when(empty, F.lit(0.0)).otherwise(c.cast("double")).alias(n))
    return one.select(*cols)


def first_month(orders: DataFrame) -> DataFrame:
    """WIN1: each customer's first order month, as (customer, first_month)."""
    return orders.groupBy(CUSTOMER_KEY).agg(F.min("order_month").alias("first_month"))


def monthly_trend(orders: DataFrame) -> DataFrame:
    """AGG5 + AGG6: per month KPIs and the new vs returning split.

    "New" means the order's month equals the customer's first month within
    the given slice (kept from the reference).
    """
    o = orders.join(first_month(orders), CUSTOMER_KEY, "inner") \
        .withColumn("is_new", F.col("order_month") == F.col("first_month"))
    t = o.groupBy("order_month").agg(
        F.sum("order_revenue").alias("revenue"),
        F.count(F.lit(1)).alias("orders"),
        F.count_distinct(CUSTOMER_KEY).alias("customers"),
        F.avg("order_revenue").alias("aov"),
        F.avg("review_score").alias("avg_review"),
        (F.avg(F.col("delivered_late").cast("double")) * 100.0).alias("late_rate"),
        F.count_if("is_new").alias("new_customer_orders"),
        F.coalesce(F.sum(F.when(F.col("is_new"), F.col("order_revenue"))), F.lit(0.0)).alias("new_customer_revenue"),
    )
    return t.withColumns({
        "revenue_per_customer": F.col("revenue") / F.col("customers"),
        "returning_orders": F.col("orders") - F.col("new_customer_orders"),
        "returning_revenue": F.col("revenue") - F.col("new_customer_revenue"),
    }).orderBy("order_month")


def category_breakdown(transactions: DataFrame, top_n: int = 15) -> DataFrame:
    """AGG7: revenue by category (% of all categories), top ``top_n`` by revenue."""
    tx = transactions.where(F.col("product_category").isNotNull())
    cat = tx.groupBy("product_category").agg(
        F.sum("item_revenue").alias("revenue"),
        F.count(F.lit(1)).alias("items"),
        F.count_distinct("order_id").alias("orders"),
        F.avg("price").alias("avg_price"),
        F.avg("review_score").alias("avg_review"),
    )
    total = cat.agg(F.sum("revenue").alias("__total"))
    return with_one_row(cat, total).withColumn("pct_revenue", pct("revenue", "__total")).drop("__total") \
        .orderBy(F.desc("revenue"), "product_category").limit(top_n)


def state_breakdown(orders: DataFrame, with_review: bool = True) -> DataFrame:
    """AGG8: revenue, orders, customers, AOV (and review) by state, % of revenue."""
    o = orders.where(F.col("customer_state").isNotNull())
    aggs = [F.sum("order_revenue").alias("revenue"), F.count(F.lit(1)).alias("orders"),
            F.count_distinct(CUSTOMER_KEY).alias("customers"), F.avg("order_revenue").alias("aov")]
    if with_review:
        aggs.append(F.avg("review_score").alias("avg_review"))
    st = o.groupBy("customer_state").agg(*aggs)
    total = st.agg(F.sum("revenue").alias("__total"))
    return with_one_row(st, total).withColumn("pct_revenue", pct("revenue", "__total")).drop("__total") \
        .orderBy(F.desc("revenue"), "customer_state")


def category_monthly(transactions: DataFrame) -> DataFrame:
    """AGG9: the category × month cube-let behind the dashboard."""
    tx = transactions.where(F.col("product_category").isNotNull() & F.col("order_month").isNotNull())
    return tx.groupBy("order_month", "product_category").agg(
        F.sum("item_revenue").alias("revenue"),
        F.count(F.lit(1)).alias("items"),
        F.count_distinct("order_id").alias("orders"),
        F.avg("review_score").alias("avg_review"),
    )


def category_totals(category_months: DataFrame) -> DataFrame:
    """AGG9 (page variant): the cube-let re-summed by category."""
    return category_months.groupBy("product_category").agg(
        F.sum("revenue").alias("revenue"), F.sum("items").alias("items"), F.sum("orders").alias("orders"))


def etl_summary(transactions: DataFrame, orders: DataFrame) -> DataFrame:
    """AGG30: window, orders, lines, customers, revenue, AOV."""
    o = orders.agg(F.min(TS).alias("first_order"), F.max(TS).alias("last_order"),
                   F.count(F.lit(1)).alias("n_orders"), F.count_distinct(CUSTOMER_KEY).alias("n_customers"),
                   F.sum("order_revenue").alias("revenue"), F.avg("order_revenue").alias("aov"))
    t = transactions.agg(F.count(F.lit(1)).alias("n_lines"))
    return with_one_row(o, t)
