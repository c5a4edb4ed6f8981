"""Named CTEs over the driver's pre-registered views; ``sql(final, *needs)``
resolves dependencies and emits ``WITH ... <final>``."""

from __future__ import annotations

import re

from patronage.config import SEGMENTS, TESTDATA_PARAMS as P

CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body.strip()


def _deps(body: str) -> list[str]:
    return [n for n in CTES if re.search(rf"\b{re.escape(n)}\b", body)]


def sql(final: str, *extra: str) -> str:
    order: list[str] = []
    seen: set[str] = set()

    def visit(n: str) -> None:
        if n in seen:
            return
        seen.add(n)
        for d in _deps(CTES[n]):
            if d != n:
                visit(d)
        order.append(n)

    for n in list(extra) + _deps(final):
        visit(n)
    if not order:
        return final.strip()
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in order) + "\n" + final.strip()


def rnd(expr: str, alias: str, places: int = 4) -> str:
    scale = float(10 ** places)
    return f"(floor(CAST({expr} AS DOUBLE) * {scale} + 0.4999713) / {scale}) AS {alias}"


STATUSES = ", ".join(f"'{s}'" for s in P.revenue_statuses)
WSTART = f"TIMESTAMP '{P.window_start} 00:00:00'"
WEND1 = f"(TIMESTAMP '{P.window_end} 00:00:00' + INTERVAL 1 DAY)"

# ---------------------------------------------------------------- adapter
cte("r_orders", """
SELECT o_orderkey AS order_id, o_orderkey AS customer_id, o_orderstatus AS order_status,
       o_orderdate AS order_purchase_timestamp,
       CAST(NULL AS TIMESTAMP) AS order_approved_at,
       CAST(NULL AS TIMESTAMP) AS order_delivered_carrier_date,
       CASE WHEN o_orderkey % 40 = 0 THEN o_orderdate - INTERVAL 1 DAY
            WHEN o_orderkey % 20 = 0 THEN CAST(NULL AS TIMESTAMP)
            ELSE o_orderdate + to_days(CAST(o_orderkey % 37 + 3 AS INTEGER)) END AS order_delivered_customer_date,
       o_orderdate + INTERVAL 30 DAY AS order_estimated_delivery_date
FROM orders""")
cte("r_customers", """
SELECT o.o_orderkey AS customer_id, o.o_custkey AS customer_unique_id,
       c.c_nationkey AS customer_zip_code_prefix, c.c_mktsegment AS customer_city, n.n_name AS customer_state
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
cte("r_items", """
SELECT l_orderkey AS order_id, CAST(l_linenumber AS SMALLINT) AS order_item_id, l_partkey AS product_id,
       l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
       l_extendedprice * (1 - l_discount) AS price, l_extendedprice * l_tax AS freight_value
FROM lineitem""")
cte("r_payments", """
SELECT order_id, CAST(seq AS SMALLINT) AS payment_sequential, payment_type, payment_installments, payment_value
FROM (SELECT o_orderkey AS order_id,
             unnest(CASE WHEN o_orderkey % 7 = 0 THEN [1, 2] ELSE [1] END) AS seq,
             o_orderpriority AS payment_type,
             CAST(o_orderkey % 10 + 1 AS SMALLINT) AS payment_installments,
             CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice / 2 ELSE o_totalprice END AS payment_value
      FROM orders)""")
cte("r_reviews", """
SELECT CAST(order_id AS VARCHAR) || '-' || CAST(seq AS VARCHAR) AS review_id, order_id,
       CAST(CASE WHEN seq = 1 THEN order_id % 5 + 1 ELSE (order_id + 2) % 5 + 1 END AS TINYINT) AS review_score,
       CASE WHEN seq = 1 THEN created ELSE created + INTERVAL 3 DAY END AS review_creation_date
FROM (SELECT o_orderkey AS order_id,
             unnest(CASE WHEN o_orderkey % 11 = 0 THEN [1, 2] ELSE [1] END) AS seq,
             o_orderdate + to_days(CAST(o_orderkey % 45 + 5 AS INTEGER)) AS created
      FROM orders WHERE o_orderkey % 10 <> 0)""")
cte("r_products", """
SELECT p_partkey AS product_id, CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_type END AS product_category_name
FROM part""")
cte("r_translation", """
SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
FROM part WHERE p_type < (SELECT max(p_type) FROM part)""")
cte("r_sellers", """
SELECT s.s_suppkey AS seller_id, s.s_nationkey AS seller_zip_code_prefix, n.n_name AS seller_state
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""")

# ---------------------------------------------------------------- cleaning
cte("c_customers", """
SELECT DISTINCT * FROM r_customers WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL""")
cte("d_orders", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY customer_id NULLS FIRST, order_status NULLS FIRST,
         order_purchase_timestamp NULLS FIRST, order_approved_at NULLS FIRST, order_delivered_carrier_date NULLS FIRST,
         order_delivered_customer_date NULLS FIRST, order_estimated_delivery_date NULLS FIRST) AS rn
  FROM r_orders) WHERE rn = 1""")
cte("c_orders", f"""
SELECT * FROM d_orders
WHERE order_status IN ({STATUSES}) AND order_purchase_timestamp IS NOT NULL
  AND order_purchase_timestamp >= {WSTART} AND order_purchase_timestamp <= {WEND1}
  AND (order_delivered_customer_date IS NULL OR order_delivered_customer_date >= order_purchase_timestamp)""")
cte("d_items", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY product_id NULLS FIRST,
         seller_id NULLS FIRST, shipping_limit_date NULLS FIRST, price NULLS FIRST, freight_value NULLS FIRST) AS rn
  FROM r_items) WHERE rn = 1""")
cte("c_items", """
SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price,
       greatest(coalesce(freight_value, 0.0), 0.0) AS freight_value
FROM d_items WHERE price IS NOT NULL AND product_id IS NOT NULL AND order_id IS NOT NULL AND price > 0""")
cte("d_payments", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, payment_sequential ORDER BY payment_type NULLS FIRST,
         payment_installments NULLS FIRST, payment_value NULLS FIRST) AS rn
  FROM r_payments) WHERE rn = 1""")
cte("c_payments", "SELECT * FROM d_payments WHERE payment_value IS NOT NULL")
cte("c_reviews", """
SELECT order_id, avg(review_score) AS review_score, count(*) AS n_reviews, max(review_creation_date) AS review_creation_date
FROM (SELECT DISTINCT * FROM r_reviews) WHERE review_score IS NOT NULL AND order_id IS NOT NULL
GROUP BY order_id""")
cte("c_translation", """
SELECT product_category_name, min(product_category_name_english) AS product_category_name_english
FROM r_translation GROUP BY product_category_name""")
cte("d_products", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY product_category_name NULLS FIRST) AS rn
  FROM r_products) WHERE rn = 1""")
cte("c_products", """
SELECT p.product_id, coalesce(p.product_category_name, 'unknown') AS product_category_name,
       coalesce(t.product_category_name_english, coalesce(p.product_category_name, 'unknown')) AS product_category
FROM d_products p LEFT JOIN c_translation t ON coalesce(p.product_category_name, 'unknown') = t.product_category_name""")
cte("c_sellers", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY seller_id ORDER BY seller_zip_code_prefix NULLS FIRST, seller_state NULLS FIRST) AS rn
  FROM r_sellers) WHERE rn = 1""")

# ---------------------------------------------------------------- marts
cte("pay_mode", """
SELECT order_id, payment_type FROM (
  SELECT order_id, payment_type, row_number() OVER (PARTITION BY order_id ORDER BY count(*) DESC, payment_type) AS rn
  FROM c_payments WHERE payment_type IS NOT NULL GROUP BY order_id, payment_type) WHERE rn = 1""")
cte("pay_agg", """
SELECT a.order_id, a.payment_total, a.n_payment_methods, a.max_installments, m.payment_type
FROM (SELECT order_id, sum(payment_value) AS payment_total, count(*) AS n_payment_methods,
             max(payment_installments) AS max_installments FROM c_payments GROUP BY order_id) a
LEFT JOIN pay_mode m ON a.order_id = m.order_id""")
cte("tx", """
SELECT i.order_id, i.order_item_id, c.customer_unique_id, o.customer_id, o.order_purchase_timestamp,
       CAST(o.order_purchase_timestamp AS DATE) AS order_date,
       CAST(date_trunc('month', o.order_purchase_timestamp) AS DATE) AS order_month,
       o.order_status, i.product_id, coalesce(p.product_category, 'unknown') AS product_category,
       i.seller_id, s.seller_state, i.price, i.freight_value, i.price + i.freight_value AS item_revenue,
       c.customer_city, c.customer_state, r.review_score, pa.payment_type, pa.max_installments,
       pa.n_payment_methods, pa.payment_total,
       date_diff('microsecond', o.order_purchase_timestamp, o.order_delivered_customer_date) / 86400000000.0 AS delivery_days,
       coalesce(o.order_delivered_customer_date > o.order_estimated_delivery_date, false) AS delivered_late,
       o.order_delivered_customer_date, r.review_creation_date
FROM c_items i
JOIN c_orders o ON i.order_id = o.order_id
JOIN c_customers c ON o.customer_id = c.customer_id
LEFT JOIN c_products p ON i.product_id = p.product_id
LEFT JOIN c_sellers s ON i.seller_id = s.seller_id
LEFT JOIN c_reviews r ON i.order_id = r.order_id
LEFT JOIN pay_agg pa ON i.order_id = pa.order_id""")
cte("om_mode", """
SELECT order_id, product_category AS top_category FROM (
  SELECT order_id, product_category, row_number() OVER (PARTITION BY order_id ORDER BY count(*) DESC, product_category) AS rn
  FROM tx WHERE product_category IS NOT NULL GROUP BY order_id, product_category) WHERE rn = 1""")
cte("om", """
SELECT a.*, m.top_category FROM (
  SELECT order_id, max(customer_unique_id) AS customer_unique_id, max(customer_id) AS customer_id,
         max(order_purchase_timestamp) AS order_purchase_timestamp, max(order_date) AS order_date,
         max(order_month) AS order_month, count(*) AS n_items, count(DISTINCT product_id) AS n_distinct_products,
         count(DISTINCT seller_id) AS n_sellers, sum(price) AS product_revenue, sum(freight_value) AS freight,
         sum(item_revenue) AS order_revenue, max(payment_total) AS payment_total, max(payment_type) AS payment_type,
         max(max_installments) AS max_installments, max(review_score) AS review_score,
         max(delivery_days) AS delivery_days, max(delivered_late) AS delivered_late,
         max(order_delivered_customer_date) AS order_delivered_customer_date,
         max(review_creation_date) AS review_creation_date, max(customer_state) AS customer_state,
         max(customer_city) AS customer_city
  FROM tx GROUP BY order_id) a LEFT JOIN om_mode m ON a.order_id = m.order_id""")

# ---------------------------------------------------------------- RFM
cte("snap", """
SELECT CAST(CAST(max(order_purchase_timestamp) AS DATE) + INTERVAL 1 DAY AS TIMESTAMP) AS snapshot FROM om""")
cte("rfm_mode", """
SELECT customer_unique_id, top_category FROM (
  SELECT customer_unique_id, top_category,
         row_number() OVER (PARTITION BY customer_unique_id ORDER BY count(*) DESC, top_category) AS rn
  FROM om WHERE top_category IS NOT NULL GROUP BY customer_unique_id, top_category) WHERE rn = 1""")
cte("rfm_state", """
SELECT customer_unique_id, customer_state FROM (
  SELECT customer_unique_id, customer_state,
         row_number() OVER (PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp, order_id) AS rn
  FROM om WHERE customer_state IS NOT NULL) WHERE rn = 1""")
cte("rfm", """
SELECT a.customer_unique_id, a.last_purchase, a.first_purchase, a.frequency, a.n_orders, a.monetary,
       a.avg_order_value, a.n_items, st.customer_state, md.top_category, a.avg_review,
       date_diff('microsecond', a.last_purchase, snap.snapshot) / 86400000000.0 AS recency,
       date_diff('microsecond', a.first_purchase, snap.snapshot) / 86400000000.0 AS tenure,
       date_diff('microsecond', a.first_purchase, snap.snapshot) / 86400000000.0 AS observed_days,
       a.frequency > 1 AS is_repeat, a.n_orders > a.frequency AS split_basket
FROM (SELECT customer_unique_id, max(order_purchase_timestamp) AS last_purchase,
             min(order_purchase_timestamp) AS first_purchase,
             count(DISTINCT CAST(order_purchase_timestamp AS DATE)) AS frequency, count(*) AS n_orders,
             sum(order_revenue) AS monetary, avg(order_revenue) AS avg_order_value,
             CAST(sum(n_items) AS BIGINT) AS n_items, avg(review_score) AS avg_review
      FROM om GROUP BY customer_unique_id) a
CROSS JOIN snap
LEFT JOIN rfm_state st ON a.customer_unique_id = st.customer_unique_id
LEFT JOIN rfm_mode md ON a.customer_unique_id = md.customer_unique_id""")
cte("thresholds", """
SELECT aov, aov * 1.0 AS monetary_cut_low, aov * 3.0 AS monetary_cut_high, 90 AS recency_cut_1,
       180 AS recency_cut_2, 365 AS recency_cut_3, 1 AS frequency_cut_1, 2 AS frequency_cut_2
FROM (SELECT avg(order_revenue) AS aov FROM om)""")
cte("scored", """
SELECT r.*,
       CASE WHEN recency <= 90 THEN 4 WHEN recency <= 180 THEN 3 WHEN recency <= 365 THEN 2 ELSE 1 END AS R,
       CASE WHEN frequency >= 3 THEN 3 WHEN frequency = 2 THEN 2 ELSE 1 END AS F,
       CASE WHEN monetary >= t.monetary_cut_high THEN 3 WHEN monetary >= t.monetary_cut_low THEN 2 ELSE 1 END AS M
FROM rfm r CROSS JOIN thresholds t""")
cte("seg", """
SELECT *, CAST(R AS VARCHAR) || CAST(F AS VARCHAR) || CAST(M AS VARCHAR) AS rfm_score,
       CASE WHEN F >= 2 AND R = 4 AND M = 3 THEN 'Champions'
            WHEN F >= 2 AND R >= 3 THEN 'Loyal'
            WHEN F >= 2 AND R = 1 AND M = 3 THEN 'Can''t Lose'
            WHEN F >= 2 AND R <= 2 THEN 'At Risk'
            WHEN F < 2 AND R = 4 AND M = 3 THEN 'Big Spender (One-Off)'
            WHEN F < 2 AND R = 4 THEN 'New'
            WHEN F < 2 AND R = 3 AND M >= 2 THEN 'Promising'
            WHEN F < 2 AND R >= 2 THEN 'Hibernating'
            WHEN F < 2 AND R = 1 THEN 'Lost'
            ELSE 'Needs Attention' END AS segment
FROM scored""")
_seg_rows = ", ".join(
    "('{}', {}, '{}')".format(n.replace("'", "''"), i, a.replace("'", "''")) for i, (n, a) in enumerate(SEGMENTS))
cte("seg_dim", f"SELECT * FROM (VALUES {_seg_rows}) AS t(segment, segment_order, action)")

# ---------------------------------------------------------------- cohorts
cte("cust_cohort", """
SELECT customer_unique_id, CAST(date_trunc('month', min(order_purchase_timestamp)) AS DATE) AS cohort_month
FROM om GROUP BY customer_unique_id""")
cte("cohort_tab", """
SELECT o.*, c.cohort_month,
       (year(o.order_month) - year(c.cohort_month)) * 12 + (month(o.order_month) - month(c.cohort_month)) AS month_index
FROM om o JOIN cust_cohort c ON o.customer_unique_id = c.customer_unique_id""")
cte("cohort_size", "SELECT cohort_month, count(*) AS customers FROM cust_cohort GROUP BY cohort_month")
cte("last_month", "SELECT max(order_month) AS lm FROM om")
cte("first_rep", """
SELECT customer_unique_id, min(cohort_month) AS cohort_month, min(month_index) AS month_index
FROM cohort_tab WHERE month_index > 0 GROUP BY customer_unique_id""")
cte("cum_rep", """
SELECT g.cohort_month, g.month_index, g.customers, coalesce(r.n, 0) AS repeaters,
       sum(coalesce(r.n, 0)) OVER (PARTITION BY g.cohort_month ORDER BY g.month_index
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_repeaters
FROM (SELECT s.cohort_month, s.customers, m.month_index FROM cohort_size s
      CROSS JOIN (SELECT DISTINCT month_index FROM first_rep) m) g
LEFT JOIN (SELECT cohort_month, month_index, count(*) AS n FROM first_rep GROUP BY 1, 2) r
  ON g.cohort_month = r.cohort_month AND g.month_index = r.month_index""")
cte("cum_rep_obs", """
SELECT c.*, 100.0 * c.cum_repeaters / c.customers AS pct FROM cum_rep c CROSS JOIN last_month l
WHERE c.month_index <= (year(l.lm) - year(c.cohort_month)) * 12 + (month(l.lm) - month(c.cohort_month))""")

# ---------------------------------------------------------------- panels
from patronage.operators.panel import origin_splits  # noqa: E402

ORIGINS = origin_splits(P)
cte("om_gaps", """
SELECT *, date_diff('microsecond', lag(order_purchase_timestamp) OVER (PARTITION BY customer_unique_id
             ORDER BY order_purchase_timestamp, order_id), order_purchase_timestamp) / 86400000000.0 AS gap
FROM om""")


def _feat_block(split: str, origin: str) -> str:
    o = f"TIMESTAMP '{origin} 00:00:00'"
    return f"""
SELECT '{split}' AS split, {o} AS origin, a.customer_unique_id, a.frequency, a.n_orders, a.monetary, a.aov,
       a.max_order, a.min_order, a.std_order, a.n_items, a.avg_items, a.n_sellers, a.avg_freight, a.total_freight,
       a.max_installments, a.n_categories, mc.top_category, st.customer_state, mp.payment_type,
       a.avg_delivery_days, a.late_rate, a.n_delivered, a.avg_review, a.min_review, a.n_reviewed,
       a.recency, a.tenure, CAST(a.frequency > 1 AS INTEGER) AS is_repeat,
       CAST(a.n_orders > a.frequency AS INTEGER) AS split_basket,
       a.frequency / nullif(a.tenure, 0) * 365 AS purchase_rate, a.monetary / nullif(a.tenure, 0) AS spend_per_day,
       a.total_freight / nullif(a.monetary, 0) AS freight_ratio, a.recency / nullif(a.tenure, 0) AS recency_over_tenure,
       a.mean_gap, a.last_gap, a.recency / nullif(a.mean_gap, 0) AS overdue_ratio,
       coalesce(t.target, 0.0) AS target
FROM (SELECT customer_unique_id, count(DISTINCT CAST(order_purchase_timestamp AS DATE)) AS frequency,
             count(*) AS n_orders, sum(order_revenue) AS monetary, avg(order_revenue) AS aov,
             max(order_revenue) AS max_order, min(order_revenue) AS min_order,
             coalesce(stddev_samp(order_revenue), 0.0) AS std_order, CAST(sum(n_items) AS BIGINT) AS n_items,
             avg(n_items) AS avg_items, CAST(sum(n_sellers) AS BIGINT) AS n_sellers, avg(freight) AS avg_freight,
             sum(freight) AS total_freight, max(max_installments) AS max_installments,
             count(DISTINCT top_category) AS n_categories,
             avg(delivery_days) FILTER (WHERE order_delivered_customer_date < {o}) AS avg_delivery_days,
             avg(CAST(delivered_late AS DOUBLE)) FILTER (WHERE order_delivered_customer_date < {o}) AS late_rate,
             count(*) FILTER (WHERE order_delivered_customer_date < {o}) AS n_delivered,
             avg(review_score) FILTER (WHERE review_creation_date < {o}) AS avg_review,
             min(review_score) FILTER (WHERE review_creation_date < {o}) AS min_review,
             count(*) FILTER (WHERE review_creation_date < {o}) AS n_reviewed,
             date_diff('microsecond', max(order_purchase_timestamp), {o}) / 86400000000.0 AS recency,
             date_diff('microsecond', min(order_purchase_timestamp), {o}) / 86400000000.0 AS tenure,
             avg(gap) FILTER (WHERE gap >= 1) AS mean_gap,
             arg_max(gap, order_purchase_timestamp) FILTER (WHERE gap >= 1) AS last_gap
      FROM om_gaps WHERE order_purchase_timestamp < {o} GROUP BY customer_unique_id) a
LEFT JOIN (SELECT customer_unique_id, top_category FROM (
             SELECT customer_unique_id, top_category, row_number() OVER (PARTITION BY customer_unique_id
                    ORDER BY count(*) DESC, top_category) AS rn
             FROM om WHERE order_purchase_timestamp < {o} AND top_category IS NOT NULL GROUP BY 1, 2) WHERE rn = 1) mc
  ON a.customer_unique_id = mc.customer_unique_id
LEFT JOIN (SELECT customer_unique_id, payment_type FROM (
             SELECT customer_unique_id, payment_type, row_number() OVER (PARTITION BY customer_unique_id
                    ORDER BY count(*) DESC, payment_type) AS rn
             FROM om WHERE order_purchase_timestamp < {o} AND payment_type IS NOT NULL GROUP BY 1, 2) WHERE rn = 1) mp
  ON a.customer_unique_id = mp.customer_unique_id
LEFT JOIN (SELECT customer_unique_id, customer_state FROM (
             SELECT customer_unique_id, customer_state, row_number() OVER (PARTITION BY customer_unique_id
                    ORDER BY order_purchase_timestamp, order_id) AS rn
             FROM om WHERE order_purchase_timestamp < {o} AND customer_state IS NOT NULL) WHERE rn = 1) st
  ON a.customer_unique_id = st.customer_unique_id
LEFT JOIN (SELECT customer_unique_id, sum(order_revenue) AS target FROM om
           WHERE order_purchase_timestamp >= {o} AND order_purchase_timestamp < {o} + INTERVAL {P.horizon_days} DAY
           GROUP BY 1) t
  ON a.customer_unique_id = t.customer_unique_id"""


cte("panel", "\nUNION ALL\n".join(_feat_block(s, o) for s, o in ORIGINS))
cte("r_geolocation", """
SELECT n_nationkey AS geolocation_zip_code_prefix, CAST(NULL AS DOUBLE) AS geolocation_lat,
       CAST(NULL AS DOUBLE) AS geolocation_lng, n_name AS geolocation_city, n_name AS geolocation_state FROM nation""")
cte("r_reviews_full", """
SELECT *, review_creation_date + INTERVAL 1 DAY AS review_answer_timestamp FROM r_reviews""")
