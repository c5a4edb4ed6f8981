from datetime import datetime

from pyspark.sql import functions as F

ORDER_SCHEMA = ("order_id long, customer_unique_id long, order_purchase_timestamp timestamp_ntz, "
                "order_revenue double, n_items long, n_sellers long, freight double, max_installments int, "
                "top_category string, customer_state string, payment_type string, review_score double, "
                "delivery_days double, delivered_late boolean, order_delivered_customer_date timestamp_ntz, "
                "review_creation_date timestamp_ntz")


def ts(s: str) -> datetime:
    return datetime.fromisoformat(s)


def orders_frame(spark, rows):
    """rows: (order_id, customer, ts, revenue) plus optional overrides dict."""
    full = []
    for r in rows:
        oid, cust, t, rev = r[:4]
        extra = r[4] if len(r) > 4 else {}
        base = dict(n_items=1, n_sellers=1, freight=0.0, max_installments=1, top_category="cat",
                    customer_state="S", payment_type="card", review_score=5.0, delivery_days=None,
                    delivered_late=False, order_delivered_customer_date=None, review_creation_date=None)
        base.update(extra)
        full.append((oid, cust, ts(t), rev, base["n_items"], base["n_sellers"], base["freight"],
                     base["max_installments"], base["top_category"], base["customer_state"], base["payment_type"],
                     base["review_score"], base["delivery_days"], base["delivered_late"],
                     base["order_delivered_customer_date"], base["review_creation_date"]))
    df = spark.createDataFrame(full, ORDER_SCHEMA)
    return df.withColumn("order_month", F.trunc("order_purchase_timestamp", "MM"))
