"""oracle_sql(): one DuckDB statement per registered query."""

from __future__ import annotations

import math

from oracle.ctes import ORIGINS as ORIGINS_, STATUSES, WEND1, WSTART, P, rnd, sql

ORACLE: dict[str, str] = {}


def o(*names: str):
    def deco(fn):
        text = fn()
        for n in names:
            ORACLE[n] = text
        return fn
    return deco


@o("fil1")
def _fil1():
    return sql("SELECT DISTINCT order_id, order_item_id, product_id, seller_id, shipping_limit_date, "
               f"{rnd('price', 'price')}, {rnd('freight_value', 'freight_value')} FROM r_items")


@o("fil2")
def _fil2():
    return sql("SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, "
               f"{rnd('price', 'price')}, {rnd('freight_value', 'freight_value')} FROM d_items")


@o("fil3", "fil7", "fil8")
def _fil3():
    return sql("SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, "
               f"{rnd('price', 'price')}, {rnd('freight_value', 'freight_value')} FROM c_items")


@o("fil4", "fil5", "fil6")
def _fil4():
    return sql("SELECT * FROM c_orders")


@o("fil9", "joi7")
def _fil9():
    return sql("SELECT product_id, product_category_name, product_category FROM c_products")


@o("agg1")
def _agg1():
    return sql(f"SELECT order_id, {rnd('payment_total', 'payment_total')}, n_payment_methods, max_installments, "
               "payment_type FROM pay_agg")


@o("agg2")
def _agg2():
    return sql(f"SELECT order_id, {rnd('review_score', 'review_score')}, n_reviews, review_creation_date FROM c_reviews")


TX_COLS = """order_id, order_item_id, customer_unique_id, customer_id, order_purchase_timestamp, order_date,
order_month, order_status, product_id, product_category, seller_id, seller_state, {price}, {freight}, {rev},
customer_city, customer_state, {review}, payment_type, max_installments, n_payment_methods, {paytot},
{deliv}, delivered_late, order_delivered_customer_date, review_creation_date""".format(
    price=rnd("price", "price"), freight=rnd("freight_value", "freight_value"),
    rev=rnd("item_revenue", "item_revenue"), review=rnd("review_score", "review_score"),
    paytot=rnd("payment_total", "payment_total"), deliv=rnd("delivery_days", "delivery_days"))


@o("fil10", "fil11", "joi1", "joi2", "joi3", "joi4", "joi5", "joi6")
def _tx():
    return sql(f"SELECT {TX_COLS} FROM tx")


OM_COLS = """order_id, customer_unique_id, customer_id, order_purchase_timestamp, order_date, order_month,
n_items, n_distinct_products, n_sellers, {pr}, {fr}, {orev}, {pt}, payment_type, max_installments, {rs}, {dd},
delivered_late, order_delivered_customer_date, review_creation_date, customer_state, customer_city,
top_category""".format(pr=rnd("product_revenue", "product_revenue"), fr=rnd("freight", "freight"),
                       orev=rnd("order_revenue", "order_revenue"), pt=rnd("payment_total", "payment_total"),
                       rs=rnd("review_score", "review_score"), dd=rnd("delivery_days", "delivery_days"))


@o("agg3", "agg31")
def _agg3():
    return sql(f"SELECT {OM_COLS} FROM om")


@o("agg10")
def _agg10():
    return sql("SELECT snapshot FROM snap")


RFM_COLS = """customer_unique_id, last_purchase, first_purchase, frequency, n_orders, {mon}, {aov}, n_items,
customer_state, top_category, {rev}, {rec}, {ten}, {obs}, is_repeat, split_basket""".format(
    mon=rnd("monetary", "monetary"), aov=rnd("avg_order_value", "avg_order_value"),
    rev=rnd("avg_review", "avg_review"), rec=rnd("recency", "recency"), ten=rnd("tenure", "tenure"),
    obs=rnd("observed_days", "observed_days"))


@o("agg11", "agg11_by_customer")
def _agg11():
    return sql(f"SELECT {RFM_COLS} FROM rfm")


@o("agg12")
def _agg12():
    return sql(f"SELECT {rnd('aov', 'aov')}, {rnd('monetary_cut_low', 'monetary_cut_low')}, "
               f"{rnd('monetary_cut_high', 'monetary_cut_high')}, recency_cut_1, recency_cut_2, recency_cut_3, "
               "frequency_cut_1, frequency_cut_2 FROM thresholds")


@o("rfm1")
def _rfm1():
    return sql(f"SELECT {RFM_COLS}, R, F, M, CAST(R AS VARCHAR) || CAST(F AS VARCHAR) || CAST(M AS VARCHAR) AS rfm_score "
               "FROM scored")


@o("rfm2", "rfm4")
def _rfm2():
    return sql(f"SELECT {RFM_COLS}, R, F, M, rfm_score, segment FROM seg")


@o("rfm3")
def _rfm3():
    return sql("SELECT 'segments: every customer assigned' AS name, "
               "CASE WHEN count(*) FILTER (WHERE segment IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, "
               "CAST(count(*) FILTER (WHERE segment IS NULL) AS DOUBLE) AS metric, CAST(0.0 AS DOUBLE) AS threshold, "
               "CAST(count(*) FILTER (WHERE segment IS NULL) AS VARCHAR) || ' unassigned customers' AS detail FROM seg")


SUMMARY = """
SELECT d.segment, d.segment_order, coalesce(p.customers, 0) AS customers, {rev},
       {am}, {ar}, {af}, {aov}, {rr}, {pc}, {pr}, {ri}, d.action
FROM seg_dim d LEFT JOIN (
  SELECT segment, count(*) AS customers, sum(monetary) AS revenue, avg(monetary) AS avg_monetary,
         avg(recency) AS avg_recency, avg(frequency) AS avg_frequency, avg(avg_order_value) AS avg_order_value,
         avg(CAST(is_repeat AS DOUBLE)) AS repeat_rate
  FROM seg GROUP BY segment) p ON d.segment = p.segment
CROSS JOIN (SELECT count(*) AS n, sum(monetary) AS rv FROM seg) t
""".format(
    rev=rnd("coalesce(p.revenue, 0.0)", "revenue"), am=rnd("p.avg_monetary", "avg_monetary"),
    ar=rnd("p.avg_recency", "avg_recency"), af=rnd("p.avg_frequency", "avg_frequency"),
    aov=rnd("p.avg_order_value", "avg_order_value"), rr=rnd("p.repeat_rate * 100.0", "repeat_rate"),
    pc=rnd("coalesce(100.0 * coalesce(p.customers, 0) / nullif(t.n, 0), 0.0)", "pct_customers"),
    pr=rnd("coalesce(100.0 * coalesce(p.revenue, 0.0) / nullif(t.rv, 0), 0.0)", "pct_revenue"),
    ri=rnd("(100.0 * coalesce(p.revenue, 0.0) / nullif(t.rv, 0)) / nullif(100.0 * coalesce(p.customers, 0) / nullif(t.n, 0), 0)",
           "revenue_index"))


@o("agg14", "joi16")
def _agg14():
    return sql(SUMMARY)


# ---------------------------------------------------------------- ledger
def _ledger_sql() -> str:
    parts = []

    def rows(base, table, counts_sql, reasons, kinds):
        prev, out = "c0", []
        for i, (reason, kind) in enumerate(zip(reasons, kinds)):
            cur = f"c{i + 1}"
            before = cur if kind == "note" else prev
            esc = reason.replace("'", "''")
            out.append(f"SELECT {base + i} AS step_id, '{table}' AS table_name, '{esc}' AS reason, "
                       f"CAST({before} AS BIGINT) AS rows_before, CAST({cur} AS BIGINT) AS rows_after FROM ({counts_sql})")
            if kind != "note":
                prev = cur
        parts.extend(out)

    rows(100, "customers",
         "SELECT (SELECT count(*) FROM r_customers) AS c0, "
         "(SELECT count(*) FROM (SELECT DISTINCT * FROM r_customers)) AS c1, "
         "(SELECT count(*) FROM (SELECT DISTINCT * FROM r_customers) WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL) AS c2",
         ["exact duplicate rows", "null customer_unique_id"], ["drop", "drop"])
    rows(200, "orders",
         "SELECT (SELECT count(*) FROM r_orders) AS c0, (SELECT count(*) FROM (SELECT DISTINCT * FROM r_orders)) AS c1, "
         "(SELECT count(DISTINCT order_id) FROM r_orders) AS c2, "
         f"(SELECT count(*) FROM d_orders WHERE order_status IN ({STATUSES})) AS c3, "
         f"(SELECT count(*) FROM d_orders WHERE order_status IN ({STATUSES}) AND order_purchase_timestamp IS NOT NULL) AS c4, "
         f"(SELECT count(*) FROM d_orders WHERE order_status IN ({STATUSES}) AND order_purchase_timestamp IS NOT NULL "
         f"AND order_purchase_timestamp >= {WSTART} AND order_purchase_timestamp <= {WEND1}) AS c5, "
         "(SELECT count(*) FROM c_orders) AS c6",
         ["exact duplicate rows", "duplicate order_id", f"status not in {list(P.revenue_statuses)}",
          "null purchase timestamp", f"outside analysis window {P.window_start}..{P.window_end}",
          "delivered before purchased"], ["drop"] * 6)
    rows(300, "order_items",
         "SELECT (SELECT count(*) FROM r_items) AS c0, (SELECT count(*) FROM (SELECT DISTINCT * FROM r_items)) AS c1, "
         "(SELECT count(*) FROM (SELECT DISTINCT order_id, order_item_id FROM r_items)) AS c2, "
         "(SELECT count(*) FROM d_items WHERE price IS NOT NULL AND product_id IS NOT NULL AND order_id IS NOT NULL) AS c3, "
         "(SELECT count(*) FROM d_items WHERE price IS NOT NULL AND product_id IS NOT NULL AND order_id IS NOT NULL AND price > 0) AS c4, "
         "(SELECT count(*) FROM d_items WHERE price IS NOT NULL AND product_id IS NOT NULL AND order_id IS NOT NULL AND price > 0 AND freight_value < 0) AS c5",
         ["exact duplicate rows", "duplicate (order_id, order_item_id)", "null price or product_id", "price <= 0",
          "negative freight clipped to 0"], ["drop", "drop", "drop", "drop", "note"])
    rows(400, "order_payments",
         "SELECT (SELECT count(*) FROM r_payments) AS c0, (SELECT count(*) FROM (SELECT DISTINCT * FROM r_payments)) AS c1, "
         "(SELECT count(*) FROM (SELECT DISTINCT order_id, payment_sequential FROM r_payments)) AS c2, "
         "(SELECT count(*) FROM c_payments) AS c3",
         ["exact duplicate rows", "duplicate (order_id, payment_sequential)", "null payment_value"], ["drop"] * 3)
    rows(500, "order_reviews",
         "SELECT (SELECT count(*) FROM r_reviews) AS c0, (SELECT count(*) FROM (SELECT DISTINCT * FROM r_reviews)) AS c1, "
         "(SELECT count(*) FROM (SELECT DISTINCT * FROM r_reviews) WHERE review_score IS NOT NULL AND order_id IS NOT NULL) AS c2, "
         "(SELECT count(*) FROM c_reviews) AS c3",
         ["exact duplicate rows", "null review_score", "collapsed to mean score per order"], ["drop"] * 3)
    rows(600, "products",
         "SELECT (SELECT count(*) FROM r_products) AS c0, (SELECT count(*) FROM (SELECT DISTINCT * FROM r_products)) AS c1, "
         "(SELECT count(DISTINCT product_id) FROM r_products) AS c2, "
         "(SELECT count(*) FROM d_products WHERE product_category_name IS NULL) AS c3",
         ["exact duplicate rows", "duplicate product_id", "null category -> 'unknown'"], ["drop", "drop", "note"])
    parts.append("SELECT 650 AS step_id, 'products' AS table_name, 'no EN translation -> kept PT name' AS reason, "
                 "CAST(count(*) AS BIGINT) AS rows_before, CAST(count(*) AS BIGINT) AS rows_after FROM d_products p "
                 "LEFT JOIN c_translation t ON coalesce(p.product_category_name, 'unknown') = t.product_category_name "
                 "WHERE t.product_category_name_english IS NULL")
    rows(700, "sellers",
         "SELECT (SELECT count(*) FROM r_sellers) AS c0, (SELECT count(*) FROM (SELECT DISTINCT * FROM r_sellers)) AS c1, "
         "(SELECT count(DISTINCT seller_id) FROM r_sellers) AS c2",
         ["exact duplicate rows", "duplicate seller_id"], ["drop", "drop"])
    rows(800, "transactions",
         "SELECT (SELECT count(*) FROM c_items) AS c0, "
         "(SELECT count(*) FROM c_items i JOIN c_orders o ON i.order_id = o.order_id) AS c1",
         ["items whose order was filtered out"], ["drop"])
    rows(801, "transactions",
         "SELECT (SELECT count(*) FROM c_items i JOIN c_orders o ON i.order_id = o.order_id) AS c0, "
         "(SELECT count(*) FROM tx) AS c1",
         ["orders with no matching customer"], ["drop"])
    body = "\nUNION ALL\n".join(parts)
    return sql(f"SELECT step_id, table_name, reason, rows_before, rows_after, rows_before - rows_after AS dropped, "
               f"{rnd('CASE WHEN rows_before > 0 THEN 100.0 * (rows_before - rows_after) / rows_before ELSE 0.0 END', 'pct')} "
               f"FROM ({body})")


ORACLE["fil12"] = _ledger_sql()

CURVE = """
SELECT t.d AS within_days, {a}, {g}
FROM (SELECT date_diff('microsecond', lag(order_purchase_timestamp) OVER (PARTITION BY customer_unique_id
             ORDER BY order_purchase_timestamp, order_id), order_purchase_timestamp) / 86400000000.0 AS gap
      FROM {src}) x
CROSS JOIN (VALUES (30), (60), (90), (120), (180), (270), (365)) AS t(d)
WHERE gap IS NOT NULL GROUP BY t.d"""


@o("agg13")
def _agg13():
    return sql(CURVE.format(a=rnd("avg(CASE WHEN gap <= t.d THEN 100.0 ELSE 0.0 END)", "pct_all_gaps"),
                            g=rnd("avg(CASE WHEN gap >= 1 THEN CASE WHEN gap <= t.d THEN 100.0 ELSE 0.0 END END)",
                                  "pct_genuine_repurchases"), src="om"))


@o("win2")
def _win2():
    src = ("(SELECT event_id AS order_id, user_id AS customer_unique_id, ts AS order_purchase_timestamp "
           "FROM events WHERE event_type = 'purchase')")
    return sql(CURVE.format(a=rnd("avg(CASE WHEN gap <= t.d THEN 100.0 ELSE 0.0 END)", "pct_all_gaps"),
                            g=rnd("avg(CASE WHEN gap >= 1 THEN CASE WHEN gap <= t.d THEN 100.0 ELSE 0.0 END END)",
                                  "pct_genuine_repurchases"), src=src))


@o("agg15")
def _agg15():
    return sql(f"""
SELECT customers, repeat_by_orders, repeat_by_occasions, split_basket_customers,
       {rnd('100.0 * repeat_by_orders / nullif(customers, 0)', 'pct_repeat_by_orders')},
       {rnd('100.0 * repeat_by_occasions / nullif(customers, 0)', 'pct_repeat_by_occasions')},
       {rnd('100.0 * split_basket_customers / nullif(customers, 0)', 'pct_split_basket')}
FROM (SELECT count(*) AS customers, count(*) FILTER (WHERE n_orders > 1) AS repeat_by_orders,
             count(*) FILTER (WHERE frequency > 1) AS repeat_by_occasions,
             count(*) FILTER (WHERE split_basket) AS split_basket_customers FROM rfm)""")


# ---------------------------------------------------------------- KPIs
@o("agg4")
def _agg4(om="om"):
    return sql(f"""
SELECT CASE WHEN n_orders = 0 THEN 0.0 ELSE {rnd('total_revenue', 'x')[:-5]} END AS total_revenue,
       n_orders, n_customers,
       CASE WHEN n_orders = 0 THEN 0.0 ELSE {rnd('aov', 'x')[:-5]} END AS aov,
       CASE WHEN n_orders = 0 THEN 0.0 ELSE {rnd('repeat_purchase_rate', 'x')[:-5]} END AS repeat_purchase_rate,
       CASE WHEN n_orders = 0 THEN 0.0 ELSE {rnd('total_revenue / nullif(n_customers, 0)', 'x')[:-5]} END AS revenue_per_customer,
       CASE WHEN n_orders = 0 THEN 0.0 ELSE {rnd('avg_items_per_order', 'x')[:-5]} END AS avg_items_per_order,
       CASE WHEN n_orders = 0 THEN 0.0 ELSE {rnd('avg_review_score', 'x')[:-5]} END AS avg_review_score,
       CASE WHEN n_orders = 0 THEN 0.0 ELSE {rnd('late_delivery_rate', 'x')[:-5]} END AS late_delivery_rate
FROM (SELECT sum(order_revenue) AS total_revenue, count(*) AS n_orders, avg(order_revenue) AS aov,
             avg(n_items) AS avg_items_per_order, avg(review_score) AS avg_review_score,
             avg(CAST(delivered_late AS DOUBLE)) * 100.0 AS late_delivery_rate FROM {om} o1) o
CROSS JOIN (SELECT count(*) AS n_customers, avg(CASE WHEN occ > 1 THEN 100.0 ELSE 0.0 END) AS repeat_purchase_rate
            FROM (SELECT customer_unique_id, count(DISTINCT CAST(order_purchase_timestamp AS DATE)) AS occ
                  FROM {om} o2 GROUP BY 1)) c""")


@o("agg5", "agg6", "win1", "joi10")
def _agg5():
    return sql(f"""
SELECT order_month, {rnd('revenue', 'revenue')}, orders, customers, {rnd('aov', 'aov')}, {rnd('avg_review', 'avg_review')},
       {rnd('late_rate', 'late_rate')}, new_customer_orders, {rnd('new_customer_revenue', 'new_customer_revenue')},
       {rnd('revenue / customers', 'revenue_per_customer')}, orders - new_customer_orders AS returning_orders,
       {rnd('revenue - new_customer_revenue', 'returning_revenue')}
FROM (SELECT o.order_month, sum(order_revenue) AS revenue, count(*) AS orders,
             count(DISTINCT o.customer_unique_id) AS customers, avg(order_revenue) AS aov, avg(review_score) AS avg_review,
             avg(CAST(delivered_late AS DOUBLE)) * 100.0 AS late_rate,
             count(*) FILTER (WHERE o.order_month = f.fm) AS new_customer_orders,
             coalesce(sum(order_revenue) FILTER (WHERE o.order_month = f.fm), 0.0) AS new_customer_revenue
      FROM om o JOIN (SELECT customer_unique_id, min(order_month) AS fm FROM om GROUP BY 1) f
        ON o.customer_unique_id = f.customer_unique_id
      GROUP BY o.order_month)""")


@o("agg7", "srt2")
def _agg7():
    return sql(f"""
SELECT product_category, {rnd('revenue', 'revenue')}, items, orders, {rnd('avg_price', 'avg_price')},
       {rnd('avg_review', 'avg_review')}, {rnd('100.0 * revenue / sum(revenue) OVER ()', 'pct_revenue')}
FROM (SELECT product_category, sum(item_revenue) AS revenue, count(*) AS items, count(DISTINCT order_id) AS orders,
             avg(price) AS avg_price, avg(review_score) AS avg_review
      FROM tx WHERE product_category IS NOT NULL GROUP BY 1)
ORDER BY revenue DESC, product_category LIMIT 15""")


@o("agg8")
def _agg8(om="om"):
    return sql(f"""
SELECT customer_state, {rnd('revenue', 'revenue')}, orders, customers, {rnd('aov', 'aov')},
       {rnd('avg_review', 'avg_review')}, {rnd('100.0 * revenue / sum(revenue) OVER ()', 'pct_revenue')}
FROM (SELECT customer_state, sum(order_revenue) AS revenue, count(*) AS orders,
             count(DISTINCT customer_unique_id) AS customers, avg(order_revenue) AS aov, avg(review_score) AS avg_review
      FROM {om} o1 WHERE customer_state IS NOT NULL GROUP BY 1)""")


@o("agg9")
def _agg9():
    return sql(f"""
SELECT order_month, product_category, {rnd('sum(item_revenue)', 'revenue')}, count(*) AS items,
       count(DISTINCT order_id) AS orders, {rnd('avg(review_score)', 'avg_review')}
FROM tx WHERE product_category IS NOT NULL AND order_month IS NOT NULL GROUP BY 1, 2""")


@o("agg9_totals")
def _agg9_totals():
    return sql(f"""
SELECT product_category, {rnd('sum(revenue)', 'revenue')}, sum(items)::BIGINT AS items, sum(orders)::BIGINT AS orders
FROM (SELECT order_month, product_category, sum(item_revenue) AS revenue, count(*) AS items,
             count(DISTINCT order_id) AS orders
      FROM tx WHERE product_category IS NOT NULL AND order_month IS NOT NULL GROUP BY 1, 2) GROUP BY 1""")


@o("agg30")
def _agg30():
    return sql(f"""
SELECT min(order_purchase_timestamp) AS first_order, max(order_purchase_timestamp) AS last_order,
       count(*) AS n_orders, count(DISTINCT customer_unique_id) AS n_customers, {rnd('sum(order_revenue)', 'revenue')},
       {rnd('avg(order_revenue)', 'aov')}, (SELECT count(*) FROM tx) AS n_lines
FROM om""")


# ---------------------------------------------------------------- cohorts
@o("agg16", "agg16_by_customer")
def _agg16():
    return sql("SELECT order_id, customer_unique_id, order_month, cohort_month, month_index FROM cohort_tab")


@o("agg17")
def _agg17():
    return sql("SELECT cohort_month, customers FROM cohort_size")


@o("agg18")
def _agg18():
    return sql(f"""
SELECT a.cohort_month, a.month_index, a.active, s.customers, {rnd('100.0 * a.active / s.customers', 'pct')}
FROM (SELECT cohort_month, month_index, count(DISTINCT customer_unique_id) AS active FROM cohort_tab GROUP BY 1, 2) a
JOIN cohort_size s ON a.cohort_month = s.cohort_month CROSS JOIN last_month l
WHERE a.month_index <= (year(l.lm) - year(a.cohort_month)) * 12 + (month(l.lm) - month(a.cohort_month))""")


@o("agg19", "win4")
def _agg19():
    return sql(f"SELECT cohort_month, month_index, customers, repeaters, CAST(cum_repeaters AS BIGINT) AS cum_repeaters, "
               f"{rnd('pct', 'pct')} FROM cum_rep_obs")


@o("agg20")
def _agg20():
    return sql(f"""
SELECT g.cohort_month, g.month_index, g.customers, {rnd('g.revenue', 'revenue')}, {rnd('g.cum_revenue', 'cum_revenue')},
       {rnd('g.cum_revenue / g.customers', 'revenue_per_customer')}
FROM (SELECT x.*, sum(revenue) OVER (PARTITION BY cohort_month ORDER BY month_index
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_revenue
      FROM (SELECT s.cohort_month, s.customers, m.month_index, coalesce(r.revenue, 0.0) AS revenue
            FROM cohort_size s CROSS JOIN (SELECT DISTINCT month_index FROM cohort_tab) m
            LEFT JOIN (SELECT cohort_month, month_index, sum(order_revenue) AS revenue FROM cohort_tab GROUP BY 1, 2) r
              ON s.cohort_month = r.cohort_month AND m.month_index = r.month_index) x) g
CROSS JOIN last_month l
WHERE g.month_index <= (year(l.lm) - year(g.cohort_month)) * 12 + (month(l.lm) - month(g.cohort_month))""")


@o("agg21")
def _agg21():
    return sql(f"""
SELECT s.cohort_month, s.customers, {rnd('r.revenue', 'revenue')}, {rnd('r.revenue / s.customers', 'revenue_per_customer')},
       {rnd('c.m3', 'repeat_by_m3')}, {rnd('c.m6', 'repeat_by_m6')}, {rnd('c.m12', 'repeat_by_m12')}
FROM cohort_size s
JOIN (SELECT cohort_month, sum(order_revenue) AS revenue FROM cohort_tab GROUP BY 1) r ON s.cohort_month = r.cohort_month
LEFT JOIN (SELECT cohort_month, max(CASE WHEN month_index = 3 THEN pct END) AS m3,
                  max(CASE WHEN month_index = 6 THEN pct END) AS m6, max(CASE WHEN month_index = 12 THEN pct END) AS m12
           FROM cum_rep_obs GROUP BY 1) c ON s.cohort_month = c.cohort_month""")


# ---------------------------------------------------------------- concentration
@o("agg22")
def _agg22():
    return sql(f"""
SELECT f AS top_fraction, CAST(floor(n * f) AS BIGINT) AS customers,
       {rnd('100.0 * sum(CASE WHEN rk <= floor(n * f) THEN monetary ELSE 0.0 END) / max(tot)', 'pct_revenue')}
FROM (SELECT monetary, row_number() OVER (ORDER BY monetary DESC, customer_unique_id) AS rk,
             count(*) OVER () AS n, sum(monetary) OVER () AS tot FROM rfm) r
CROSS JOIN (VALUES (0.01), (0.05), (0.10), (0.20)) AS t(f)
GROUP BY f, n""".replace("VALUES (0.01), (0.05), (0.10), (0.20)",
                         "VALUES (CAST(0.01 AS DOUBLE)), (CAST(0.05 AS DOUBLE)), (CAST(0.10 AS DOUBLE)), (CAST(0.20 AS DOUBLE))"))


@o("agg23")
def _agg23():
    return sql(f"""
SELECT n, {rnd('2.0 * w / (n * tot) - (n + 1.0) / n', 'gini')}
FROM (SELECT count(*) AS n, sum(monetary) AS tot, sum(i * monetary) AS w
      FROM (SELECT monetary, row_number() OVER (ORDER BY monetary, customer_unique_id) AS i FROM rfm))""")


@o("rnk3")
def _rnk3():
    return sql(f"""
SELECT 'curve' AS point_type, rk AS rank, {rnd('100.0 * rk / n', 'customer_share')},
       {rnd('100.0 * cum / tot', 'revenue_share')}
FROM (SELECT rk, n, tot, sum(monetary) OVER (ORDER BY rk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
             greatest(floor(n / 2000), 1) AS step
      FROM (SELECT monetary, row_number() OVER (ORDER BY monetary DESC, customer_unique_id) AS rk,
                   count(*) OVER () AS n, sum(monetary) OVER () AS tot FROM rfm))
WHERE (rk - 1) % step = 0
UNION ALL
SELECT 'marker_' || CAST(m AS VARCHAR) AS point_type, CAST(floor(n * m / 100.0) AS BIGINT) AS rank,
       {rnd('m', 'customer_share')},
       CASE WHEN floor(n * m / 100.0) >= 1 THEN
         {rnd('100.0 * sum(CASE WHEN rk <= floor(n * m / 100.0) THEN monetary ELSE 0.0 END) / max(tot)', 'x')[:-5]} END
         AS revenue_share
FROM (SELECT monetary, row_number() OVER (ORDER BY monetary DESC, customer_unique_id) AS rk,
             count(*) OVER () AS n, sum(monetary) OVER () AS tot FROM rfm)
CROSS JOIN (VALUES (5), (20)) AS t(m)
GROUP BY m, n""")


@o("rnk1")
def _rnk1():
    return sql(f"SELECT customer_unique_id, {rnd('monetary', 'monetary')}, "
               "row_number() OVER (ORDER BY monetary DESC, customer_unique_id) AS rank FROM rfm")


@o("rnk2")
def _rnk2():
    return sql(f"""
SELECT customer_unique_id, {rnd('monetary', 'monetary')}, rank,
       CAST(greatest(1, least(5, ceil((rank - 1) * 5.0 / greatest(n - 1, 1)))) AS INTEGER) AS bin
FROM (SELECT customer_unique_id, monetary, row_number() OVER (ORDER BY monetary DESC, customer_unique_id) AS rank,
             count(*) OVER () AS n FROM rfm)""")


# ---------------------------------------------------------------- panels
from patronage.operators.panel import FEATURES  # noqa: E402

_DOUBLE_FEATS = {"monetary", "aov", "max_order", "min_order", "std_order", "avg_items", "avg_freight",
                 "total_freight", "avg_delivery_days", "late_rate", "avg_review", "min_review", "recency", "tenure",
                 "purchase_rate", "spend_per_day", "freight_ratio", "recency_over_tenure", "mean_gap", "last_gap",
                 "overdue_ratio"}
PANEL_COLS = ", ".join(["split", "origin", "customer_unique_id"]
                       + [rnd(f, f) if f in _DOUBLE_FEATS else f for f in FEATURES] + [rnd("target", "target")])


@o("fea1", "fea2", "fea3", "fea4", "fea5", "fea6", "set1", "fil18", "joi11", "joi12", "win5")
def _fea1():
    return sql(f"SELECT {PANEL_COLS} FROM panel")


@o("fea8")
def _fea8():
    cats = ("top_category", "customer_state", "payment_type")
    cols = [f"l_{f}.v AS {f}" if f in cats else rnd(f, f) if f in _DOUBLE_FEATS or f == "target" else f
            for f in ["split", "origin", "customer_unique_id"] + list(FEATURES) + ["target"]]
    levels = " ".join(f"LEFT JOIN (SELECT DISTINCT {f} AS v FROM panel WHERE split = 'train') l_{f} ON l_{f}.v = panel.{f}"
                      for f in cats)
    return sql(f"SELECT {', '.join(cols)} FROM panel {levels}").replace("panel AS (", "panel AS MATERIALIZED (", 1)


@o("fea10")
def _fea10():
    return sql(f"""
SELECT split, count(*) AS rows, count(*) FILTER (WHERE target > 0) AS positives,
       {rnd('100.0 * count(*) FILTER (WHERE target > 0) / count(*)', 'pct_positive')},
       {rnd('sum(target)', 'target_sum')},
       array_to_string(list_sort(list(DISTINCT strftime(origin, '%Y-%m-%d'))), ',') AS origins
FROM panel GROUP BY split""")


@o("fea9", "set2")
def _fea9():
    blocks = []
    for _, org in ORIGINS_:
        ot = f"TIMESTAMP '{org} 00:00:00'"
        blocks.append(f"""
SELECT {ot} AS origin, customer_unique_id, count(*) AS n,
       count(*) FILTER (WHERE order_delivered_customer_date >= {ot}) AS ld,
       count(*) FILTER (WHERE review_creation_date >= {ot}) AS lr,
       count(*) FILTER (WHERE order_delivered_customer_date >= {ot} OR review_creation_date >= {ot}) AS leaky,
       count(*) FILTER (WHERE order_delivered_customer_date < {ot}) AS not_ld,
       count(*) FILTER (WHERE review_creation_date < {ot}) AS not_lr,
       avg(delivery_days) AS naive_d, avg(delivery_days) FILTER (WHERE order_delivered_customer_date < {ot}) AS masked_d,
       avg(review_score) AS naive_r, avg(review_score) FILTER (WHERE review_creation_date < {ot}) AS masked_r
FROM om WHERE order_purchase_timestamp < {ot} GROUP BY customer_unique_id""")
    pc = "\nUNION ALL\n".join(blocks)
    return sql(f"""
SELECT c.origin, sum(n) AS pre_origin_orders, sum(ld) AS orders_delivered_after_origin,
       sum(lr) AS orders_reviewed_after_origin, count(*) FILTER (WHERE leaky > 0) AS customers_affected,
       count(*) AS scored_customers,
       count(*) FILTER (WHERE ld > 0 AND not_ld = 0 AND p.avg_delivery_days IS NOT NULL) AS delivery_violations,
       count(*) FILTER (WHERE lr > 0 AND not_lr = 0 AND p.avg_review IS NOT NULL) AS review_violations,
       count(*) FILTER (WHERE naive_d IS DISTINCT FROM masked_d OR naive_r IS DISTINCT FROM masked_r) AS customers_naive_differs,
       {rnd('100.0 * count(*) FILTER (WHERE leaky > 0) / greatest(count(*), 1)', 'pct_customers_affected')}
FROM ({pc}) c LEFT JOIN panel p ON c.origin = p.origin AND c.customer_unique_id = p.customer_unique_id
GROUP BY c.origin""")


@o("fea11", "fea11_by_customer", "win3")
def _fea11():
    ot = f"TIMESTAMP '{P.test_origin} 00:00:00'"
    return sql(f"""
SELECT customer_unique_id, CAST(count(*) - 1 AS BIGINT) AS frequency,
       {rnd("date_diff('microsecond', CAST(min(day) AS TIMESTAMP), CAST(max(day) AS TIMESTAMP)) / 86400000000.0", 'recency')},
       {rnd(f"date_diff('microsecond', CAST(min(day) AS TIMESTAMP), {ot}) / 86400000000.0", 'T')},
       {rnd('CASE WHEN count(*) > 1 THEN (sum(rev) - arg_min(rev, day)) / (count(*) - 1) ELSE 0.0 END', 'monetary_value')}
FROM (SELECT customer_unique_id, CAST(order_purchase_timestamp AS DATE) AS day, sum(order_revenue) AS rev
      FROM om WHERE order_purchase_timestamp < {ot} GROUP BY 1, 2)
GROUP BY customer_unique_id""")


@o("fea12")
def _fea12():
    ot = f"TIMESTAMP '{P.test_origin} 00:00:00'"
    return sql(f"SELECT customer_unique_id, {rnd('avg(order_revenue)', 'observed_aov')} FROM om "
               f"WHERE order_purchase_timestamp < {ot} GROUP BY 1")


# ---------------------------------------------------------------- evaluation
SCORES = ("(SELECT 'historical_spend' AS model, customer_unique_id AS key, CAST(target AS DOUBLE) AS y, "
          "CAST(monetary AS DOUBLE) AS p FROM panel WHERE split = 'test')")


@o("mod11", "eva1", "eva2", "eva3", "eva4")
def _eva1():
    return sql(f"""
SELECT model, count(*) AS n, {rnd('avg(abs(p - y))', 'mae')}, {rnd('sqrt(avg((p - y) * (p - y)))', 'rmse')},
       {rnd('sum(p)', 'predicted_total')}, {rnd('sum(y)', 'actual_total')}, count(*) FILTER (WHERE y > 0) AS n_positives,
       {rnd('(sum(mr_p) FILTER (WHERE y > 0) - pp * (pp + 1) / 2.0) / (pp * (count(*) - pp))', 'auc')},
       {rnd('corr(mr_y, mr_p)', 'spearman')},
       {rnd('100.0 * coalesce(sum(y) FILTER (WHERE rank_desc <= greatest(floor(0.1 * n), 1)), 0.0) / greatest(sum(y), 1e-9)', 'top_capture')},
       {rnd('100.0 * coalesce(sum(y) FILTER (WHERE rank_desc <= greatest(floor(0.1 * n), 1)), 0.0) / greatest(sum(y), 1e-9) / (100.0 * 0.1)', 'top_lift')}
FROM (SELECT *, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS mr_p,
             rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS mr_y,
             row_number() OVER (ORDER BY p DESC, key) AS rank_desc, count(*) OVER () AS n,
             count(*) FILTER (WHERE y > 0) OVER () AS pp
      FROM {SCORES})
GROUP BY model, pp""")


@o("eva7")
def _eva7():
    return sql(f"""
SELECT model, bin, customers, {rnd('mean_predicted', 'mean_predicted')}, {rnd('mean_actual', 'mean_actual')},
       {rnd('total_actual', 'total_actual')}, n_returned, {rnd('100.0 * n_returned / customers', 'return_rate')},
       {rnd('100.0 * total_actual / greatest(sum(total_actual) OVER (), 1e-9)', 'pct_of_actual_revenue')},
       {rnd('mean_predicted / nullif(mean_actual, 0.0)', 'calibration_ratio')}
FROM (SELECT model, 'Q' || CAST(CAST(greatest(1, least(5, ceil((rk - 1) * 5.0 / greatest(n - 1, 1)))) AS INTEGER) AS VARCHAR) AS bin,
             count(*) AS customers, avg(p) AS mean_predicted, avg(y) AS mean_actual, sum(y) AS total_actual,
             count(*) FILTER (WHERE y > 0) AS n_returned
      FROM (SELECT *, row_number() OVER (ORDER BY p DESC, key) AS rk, count(*) OVER () AS n FROM {SCORES})
      GROUP BY 1, 2)""")


@o("eva9")
def _eva9():
    return sql(f"""
SELECT 'predict zero' AS baseline, {rnd('avg(abs(target))', 'MAE')}, {rnd('sqrt(avg(target * target))', 'RMSE')}
FROM panel WHERE split = 'test'
UNION ALL
SELECT 'predict train mean' AS baseline, {rnd('avg(abs(m - target))', 'MAE')}, {rnd('sqrt(avg((m - target) * (m - target)))', 'RMSE')}
FROM panel CROSS JOIN (SELECT avg(target) AS m FROM panel WHERE split = 'train') t WHERE split = 'test'""")


cte_top = f"""
SELECT model, CAST(0.1 AS DOUBLE) AS fraction, CAST(max(k) AS BIGINT) AS n_targeted,
       coalesce(sum(y) FILTER (WHERE rk <= k), 0.0) AS revenue_in_group, sum(y) AS revenue_total,
       count(*) FILTER (WHERE rk <= k AND y > 0) AS n_returners
FROM (SELECT *, row_number() OVER (ORDER BY p DESC, key) AS rk, greatest(floor(count(*) OVER () * 0.1), 1) AS k
      FROM {SCORES}) GROUP BY model"""


# Poisson(1) weights of the bootstrap: integers modulo 2^31 - 1, as in the library.
_M = 2147483647
_LIMITS = [math.floor(_M * math.exp(-1) * sum(
    1 / math.factorial(j) for j in range(k + 1))) for k in range(12)]


def _weighted(rows: str, n_boot: int) -> str:
    """``rows`` (with key) once for each replicate: replicate, w."""
    def fifth(x, cols):
        sq = f"SELECT *, {x} * {x} % {_M} AS s2 FROM {cols}"
        return f"(SELECT * EXCLUDE ({x}, s2), (s2 * s2 % {_M}) * {x} % {_M} AS {x} FROM ({sq}))"
    digest = "md5(CAST(key AS VARCHAR))"
    base = f"""(SELECT r.*, b.replicate, CAST('0x' || substr({digest}, 8, 7) AS BIGINT) AS h2,
  (CAST('0x' || substr({digest}, 1, 7) AS BIGINT) + CAST(b.replicate AS BIGINT) * 1000003) % {_M} AS x
  FROM {rows} r CROSS JOIN (SELECT unnest(range(1, {n_boot + 1})) AS replicate) b)"""
    once = fifth("x", base)
    twice = fifth("x", f"(SELECT * EXCLUDE (x), (x + h2) % {_M} AS x FROM {once})")
    w = " + ".join(f"CAST(x >= {t} AS INTEGER)" for t in _LIMITS)
    return f"(SELECT * FROM (SELECT * EXCLUDE (x, h2), {w} AS w FROM {twice}) WHERE w > 0)"


def _captures(n_boot: int) -> str:
    return f"""(SELECT model, replicate, 100.0 * sum(greatest(least(w, k - upto), 0) * y) / greatest(any_value(wy), 1e-9) AS top_capture
  FROM (SELECT *, greatest(floor(sw * CAST(0.1 AS DOUBLE)), 1) AS k FROM (
    SELECT *, sum(w) OVER (PARTITION BY model, replicate) AS sw, sum(w * y) OVER (PARTITION BY model, replicate) AS wy,
           coalesce(sum(w) OVER (PARTITION BY model, replicate ORDER BY p DESC, key
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto
    FROM {_weighted(SCORES, n_boot)}))
  GROUP BY model, replicate HAVING count(*) FILTER (WHERE y > 0) > 0 AND count(*) FILTER (WHERE y <= 0) > 0)"""


def _ends(v: str, alias: str) -> str:
    return f"quantile_cont({v}, 0.025) AS {alias}_lo, quantile_cont({v}, 0.975) AS {alias}_hi"


def _intervals(n_boot: int) -> str:
    tie = "sum(w) OVER (PARTITION BY model, replicate, {v})"
    below = "(sum(w) OVER (PARTITION BY model, replicate ORDER BY {v} RANGE UNBOUNDED PRECEDING) - " + tie + ")"
    mid = "CAST(" + below + " AS DOUBLE) + (" + tie + " + 1) / 2.0"
    return f"""(SELECT model, {_ends('auc', 'auc')}, {_ends('spearman', 'spearman')}, {_ends('top_capture', 'top_capture')}
FROM (SELECT model, replicate, (sum(w * mp) FILTER (WHERE y > 0) - wpos * (wpos + 1) / 2.0) / (wpos * (sw - wpos)) AS auc,
             (sum(w * mp * my) / sw - sum(w * mp) / sw * (sum(w * my) / sw))
               / sqrt((sum(w * mp * mp) / sw - pow(sum(w * mp) / sw, 2)) * (sum(w * my * my) / sw - pow(sum(w * my) / sw, 2)))
               AS spearman
      FROM (SELECT *, {mid.format(v='p')} AS mp, {mid.format(v='y')} AS my,
                   CAST(sum(w) OVER (PARTITION BY model, replicate) AS DOUBLE) AS sw,
                   CAST(sum(CASE WHEN y > 0 THEN w ELSE 0 END) OVER (PARTITION BY model, replicate) AS DOUBLE) AS wpos
            FROM {_weighted(SCORES, n_boot)})
      WHERE wpos > 0 AND wpos < sw GROUP BY model, replicate, sw, wpos)
JOIN {_captures(n_boot)} USING (model, replicate) GROUP BY model)"""


def _verdict(lo: str, hi: str) -> str:
    return f"CASE WHEN {lo} > 0.5 THEN 'yes' WHEN {hi} < 0.5 THEN 'WORSE' ELSE 'no' END"


_ENDS = [f"{m}_{e}" for m in ("auc", "spearman", "top_capture") for e in ("lo", "hi")]


@o("eva5", "eva6")
def _eva5():
    return sql(f"""
SELECT model, {', '.join(rnd(c, c) for c in _ENDS)}, auc_lo > 0.5 AS auc_beats, auc_hi < 0.5 AS auc_loses,
       {_verdict('auc_lo', 'auc_hi')} AS auc_verdict, {rnd('auc_hi - auc_lo', 'auc_width')}
FROM {_intervals(P.n_boot)}""")


@o("eva10_spend")
def _eva10_spend():
    point = ORACLE["eva1"]
    head, tail = point.rsplit("\nSELECT model, count(*) AS n,", 1)
    return f"""{head},
point AS (SELECT model, count(*) AS n,{tail})
SELECT model, mae, rmse, auc, {rnd('auc_lo', 'auc_lo')}, {rnd('auc_hi', 'auc_hi')}, spearman,
       {', '.join(rnd(c, c) for c in _ENDS[2:])}, top_capture, top_lift, auc_lo > 0.5 AS beats_random,
       {_verdict('auc_lo', 'auc_hi')} AS verdict_vs_random, n_positives, predicted_total, actual_total
FROM point JOIN {_intervals(P.n_boot)} USING (model)"""


@o("eva8")
def _eva8():
    binned = f"""(SELECT *, 'Q' || CAST(CAST(greatest(1, least(5, ceil((rk - 1) * 5.0 / greatest(n - 1, 1)))) AS INTEGER) AS VARCHAR) AS bin
  FROM (SELECT *, row_number() OVER (ORDER BY p DESC, key) AS rk, count(*) OVER () AS n FROM {SCORES}))"""
    ends = [(m, e) for m in ("actual", "return_rate") for e in ("lo", "hi")]
    return sql(f"""
SELECT model, bin, {', '.join(rnd(f'{m}_{e}', f'{m}_{e}') for m, e in ends)}
FROM (SELECT model, bin, {_ends('m', 'actual')}, {_ends('rr', 'return_rate')}
      FROM (SELECT model, bin, replicate, CAST(sum(w * y) AS DOUBLE) / sum(w) AS m,
                   100.0 * sum(CASE WHEN y > 0 THEN w ELSE 0 END) / sum(w) AS rr
            FROM {_weighted(binned, P.n_boot_bands)} GROUP BY model, bin, replicate)
      GROUP BY model, bin)""")


@o("roi4_spend")
def _roi4_spend():
    return sql(f"""
SELECT t.model AS strategy, n_targeted AS customers_targeted, n_returners AS returners_reached,
       {rnd('revenue_in_group', 'revenue_captured')}, {rnd('100.0 * revenue_in_group / greatest(revenue_total, 1e-9)', 'capture_pct')},
       {rnd('capture_lo', 'capture_lo')}, {rnd('capture_hi', 'capture_hi')},
       {rnd('100.0 * revenue_in_group / greatest(revenue_total, 1e-9) / (100.0 * 0.1)', 'lift')}
FROM ({cte_top}) t JOIN (SELECT model, {_ends('top_capture', 'capture')} FROM {_captures(P.n_boot_strategies)} GROUP BY model) USING (model)
UNION ALL
SELECT 'Random targeting', CAST(floor(count(*) * 0.1) AS BIGINT), CAST(round(count(*) FILTER (WHERE y > 0) * 0.1) AS BIGINT),
       {rnd('sum(y) * 0.1', 'revenue_captured')}, {rnd('10.0', 'capture_pct')}, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
       {rnd('1.0', 'lift')}
FROM {SCORES}""")


@o("roi1", "srt4")
def _roi1():
    return sql(f"""
SELECT model, fraction, n_targeted, {rnd('revenue_in_group', 'revenue_in_group')}, {rnd('revenue_total', 'revenue_total')},
       n_returners, {rnd('100.0 * revenue_in_group / greatest(revenue_total, 1e-9)', 'capture_pct')},
       {rnd('100.0 * revenue_in_group / greatest(revenue_total, 1e-9) / (100.0 * 0.1)', 'lift')}
FROM ({cte_top})""")


_CH = "[" + ", ".join(f"{{'name': '{n}', 'cost': CAST({c} AS DOUBLE)}}" for n, c in
                      __import__("patronage.config", fromlist=["CHANNEL_COSTS"]).CHANNEL_COSTS) + "]"


@o("roi2")
def _roi2():
    return sql(f"""
SELECT model, label AS incremental_uplift, {rnd('revenue_in_group * u', 'incremental_revenue')},
       {rnd('be', 'breakeven_cost_per_contact')},
       coalesce(nullif(array_to_string(list_transform(list_filter({_CH}, lambda c: c.cost <= be), lambda c: c.name), ', '), ''), 'NONE')
         AS viable_channels
FROM (SELECT t.*, x.u, x.label, t.revenue_in_group * x.u / greatest(t.n_targeted, 1) AS be
      FROM ({cte_top}) t CROSS JOIN (VALUES (CAST(0.02 AS DOUBLE), '2%'), (CAST(0.05 AS DOUBLE), '5%'),
                                             (CAST(0.10 AS DOUBLE), '10%'), (CAST(0.20 AS DOUBLE), '20%')) AS x(u, label))""")


@o("roi3")
def _roi3():
    return sql(f"""
SELECT model, c.name AS channel, {rnd('c.cost', 'cost_per_contact')}, {rnd('n_targeted * c.cost', 'campaign_cost')},
       {rnd('revenue_in_group * 0.05 - n_targeted * c.cost', 'net_at_5pct')},
       {rnd('revenue_in_group * 0.10 - n_targeted * c.cost', 'net_at_10pct')},
       {rnd('revenue_in_group * 0.20 - n_targeted * c.cost', 'net_at_20pct')},
       CASE WHEN revenue_in_group * 0.10 - n_targeted * c.cost > 0 THEN 'profitable' ELSE 'net-negative' END AS verdict
FROM (SELECT t.*, unnest({_CH}) AS c FROM ({cte_top}) t)""")


@o("srt3")
def _srt3():
    return sql(f"SELECT model, key, {rnd('y', 'y')}, {rnd('p', 'p')} FROM {SCORES} ORDER BY p DESC, key LIMIT 200")


@o("rnk4")
def _rnk4():
    return sql(f"""
SELECT CAST(key AS VARCHAR) AS probe_id, {rnd('p', 'value')}, rank() OVER (ORDER BY p) - 1 AS scores_below,
       {rnd('100.0 * (rank() OVER (ORDER BY p) - 1) / count(*) OVER ()', 'percentile')}
FROM {SCORES}""")


# ---------------------------------------------------------------- quality
def _chk(cid, name, status, metric, threshold, detail, src):
    return (f"SELECT {cid} AS check_id, '{name}' AS name, {status} AS status, "
            f"{rnd(metric, 'metric')}, {rnd(threshold, 'threshold')}, {detail} AS detail FROM ({src})")


def _pk():
    out = []
    for i, (name, cte_name, keys) in enumerate([
            ("customers", "c_customers", ["customer_id"]), ("orders", "c_orders", ["order_id"]),
            ("order_items", "c_items", ["order_id", "order_item_id"]),
            ("order_payments", "c_payments", ["order_id", "payment_sequential"]),
            (None, None, None), ("products", "c_products", ["product_id"]), ("sellers", "c_sellers", ["seller_id"]),
            ("category_translation", "c_translation", ["product_category_name"])]):
        if name is None:
            continue
        src = f"SELECT count(*) - count(DISTINCT ({', '.join(keys)})) AS dup FROM {cte_name}"
        out.append(_chk(100 + i, f"pk unique: {name}({'+'.join(keys)})", "CASE WHEN dup = 0 THEN 'PASS' ELSE 'FAIL' END",
                        "dup", 0, "CASE WHEN dup = 0 THEN 'unique' ELSE CAST(dup AS VARCHAR) || ' duplicate keys remain' END",
                        src))
    return out


def _req():
    specs = [("customers", "c_customers", ["customer_id", "customer_unique_id"]),
             ("orders", "c_orders", ["order_id", "customer_id", "order_status", "order_purchase_timestamp"]),
             ("order_items", "c_items", ["order_id", "order_item_id", "product_id", "seller_id", "price"]),
             ("order_payments", "c_payments", ["order_id", "payment_sequential", "payment_type", "payment_value"]),
             ("order_reviews", "c_reviews", ["order_id", "review_score"]),
             ("products", "c_products", ["product_id"]), ("sellers", "c_sellers", ["seller_id"]),
             ("category_translation", "c_translation", ["product_category_name", "product_category_name_english"])]
    out = []
    for i, (name, cte_name, cols) in enumerate(specs):
        aggs = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS n{j}" for j, c in enumerate(cols))
        total = " + ".join(f"n{j}" for j in range(len(cols)))
        listing = "concat_ws(', ', " + ", ".join(
            f"CASE WHEN n{j} > 0 THEN '{c}=' || CAST(n{j} AS VARCHAR) END" for j, c in enumerate(cols)) + ")"
        src = f"SELECT {aggs} FROM {cte_name}"
        out.append(_chk(200 + i, f"required non-null: {name}", f"CASE WHEN {total} = 0 THEN 'PASS' ELSE 'FAIL' END",
                        total, 0, f"CASE WHEN {total} = 0 THEN 'all required columns populated' "
                                  f"ELSE 'nulls in {{' || {listing} || '}}' END", src))
    return out


def _fk():
    fks = [("orders", "customer_id", "c_orders", "customers", "c_customers", "customer_id"),
           ("order_items", "product_id", "c_items", "products", "c_products", "product_id"),
           ("order_items", "seller_id", "c_items", "sellers", "c_sellers", "seller_id")]
    out = []
    for i, (name, col, cte_c, pname, cte_p, pcol) in enumerate(fks):
        src = (f"SELECT count(*) AS miss FROM {cte_c} c WHERE c.{col} IS NOT NULL "
               f"AND NOT EXISTS (SELECT 1 FROM {cte_p} p WHERE p.{pcol} = c.{col})")
        out.append(_chk(300 + i, f"FK: {name}.{col} -> {pname}.{pcol}", "CASE WHEN miss = 0 THEN 'PASS' ELSE 'FAIL' END",
                        "miss", 0, "CASE WHEN miss = 0 THEN 'all values resolve' ELSE CAST(miss AS VARCHAR) || ' orphaned values' END",
                        src))
    return out


def _txq():
    src = ("SELECT count(*) FILTER (WHERE customer_unique_id IS NULL) AS nk, count(*) FILTER (WHERE item_revenue <= 0) AS bad, "
           "coalesce(max(abs(price + freight_value - item_revenue)), 0.0) AS drift, "
           "count(*) - count(DISTINCT (order_id, order_item_id)) AS dup FROM tx")
    return [
        _chk(400, "transactions: customer key populated", "CASE WHEN nk = 0 THEN 'PASS' ELSE 'FAIL' END", "nk", 0,
             "CASE WHEN nk = 0 THEN 'no nulls' ELSE CAST(nk AS VARCHAR) || ' nulls' END", src),
        _chk(401, "transactions: item_revenue > 0", "CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END", "bad", 0,
             "CASE WHEN bad = 0 THEN 'all positive' ELSE CAST(bad AS VARCHAR) || ' non-positive rows' END", src),
        _chk(402, "transactions: revenue = price + freight", "CASE WHEN drift < 1e-6 THEN 'PASS' ELSE 'FAIL' END",
             "drift", 1e-6, "'max drift in metric'", src),
        _chk(403, "transactions: grain is (order_id, order_item_id)", "CASE WHEN dup = 0 THEN 'PASS' ELSE 'FAIL' END",
             "dup", 0, "CASE WHEN dup = 0 THEN 'unique' ELSE CAST(dup AS VARCHAR) || ' duplicates' END", src),
    ]


def _rec():
    src = ("SELECT * FROM (SELECT count(DISTINCT order_id) AS txo, sum(item_revenue) AS tx_rev FROM tx) "
           "CROSS JOIN (SELECT count(*) AS rws, sum(order_revenue) AS o_rev, "
           "count(*) FILTER (WHERE payment_total IS NOT NULL) AS with_pay, "
           "sum(order_revenue) FILTER (WHERE payment_total IS NOT NULL) AS rev_p, "
           "sum(payment_total) FILTER (WHERE payment_total IS NOT NULL) AS pay_p, "
           "count(*) FILTER (WHERE payment_total IS NULL) AS no_pay FROM om)")
    drift = "abs(coalesce(tx_rev, 0.0) - coalesce(o_rev, 0.0))"
    gap = "100.0 * abs(pay_p - rev_p) / rev_p"
    return [
        _chk(500, "orders: one row per distinct order in transactions", "CASE WHEN rws = txo THEN 'PASS' ELSE 'FAIL' END",
             "rws - txo", 0, "CAST(rws AS VARCHAR) || ' order rows vs ' || CAST(txo AS VARCHAR) || ' distinct in transactions'",
             src),
        _chk(501, "orders: revenue reconciles to transactions", f"CASE WHEN {drift} < 0.01 THEN 'PASS' ELSE 'FAIL' END",
             drift, 0.01, "'drift in metric'", src),
        _chk(502, "orders: item revenue vs payments cross-check", f"CASE WHEN {gap} < 5 THEN 'PASS' ELSE 'WARN' END",
             gap, 5, "'% apart in metric'", src + " WHERE with_pay > 0"),
        _chk(503, "orders: payment record present", "CASE WHEN no_pay = 0 THEN 'PASS' ELSE 'WARN' END", "no_pay", 0,
             "CASE WHEN no_pay = 0 THEN 'all orders have payments' ELSE CAST(no_pay AS VARCHAR) || ' orders lack a payment row' END",
             src),
    ]


def _tmp():
    w = ("SELECT min(order_purchase_timestamp) AS lo, max(order_purchase_timestamp) AS hi, "
         "count(DISTINCT date_trunc('month', order_purchase_timestamp)) AS months, "
         "count(*) FILTER (WHERE delivery_days < 0) AS neg FROM om")
    th = ("SELECT count(*) FILTER (WHERE n < 0.25 * med) AS thin, max(med) AS med, max(mn) AS mn FROM "
          "(SELECT order_month, count(*) AS n FROM om GROUP BY 1) m CROSS JOIN "
          "(SELECT median(n) AS med, min(n) AS mn FROM (SELECT order_month, count(*) AS n FROM om GROUP BY 1))")
    return [
        _chk(600, "orders: purchase timestamps in window", "'PASS'", "months", 0,
             "strftime(lo, '%Y-%m-%d') || ' .. ' || strftime(hi, '%Y-%m-%d') || ' (' || CAST(months AS VARCHAR) || ' months)'", w),
        _chk(601, "orders: no anaemic month at the tails", "CASE WHEN thin = 0 THEN 'PASS' ELSE 'WARN' END", "thin", 0,
             "'min month ' || CAST(CAST(mn AS BIGINT) AS VARCHAR) || ' orders, ' || CAST(thin AS VARCHAR) || ' thin months'", th),
        _chk(602, "orders: delivery never precedes purchase", "CASE WHEN neg = 0 THEN 'PASS' ELSE 'FAIL' END", "neg", 0,
             "CASE WHEN neg = 0 THEN 'chronology consistent' ELSE CAST(neg AS VARCHAR) || ' negative durations' END", w),
    ]


def _idn():
    src = ("SELECT * FROM (SELECT count(*) AS uniq, count(*) FILTER (WHERE n > 1) AS rep, "
           "count(*) FILTER (WHERE occ > 1) AS rep_occ FROM (SELECT customer_unique_id, count(*) AS n, "
           "count(DISTINCT CAST(order_purchase_timestamp AS DATE)) AS occ FROM om GROUP BY 1)) "
           "CROSS JOIN (SELECT count(DISTINCT customer_id) AS sur FROM om)")
    return [
        _chk(700, "identity: customer_unique_id collapses surrogates", "CASE WHEN uniq < sur THEN 'PASS' ELSE 'FAIL' END",
             "sur - uniq", 0, "CAST(sur AS VARCHAR) || ' order-level customer_id -> ' || CAST(uniq AS VARCHAR) || ' real customers'",
             src),
        _chk(701, "identity: repeat buyers exist", "CASE WHEN rep > 0 THEN 'PASS' ELSE 'FAIL' END", "rep", 0,
             "CAST(rep AS VARCHAR) || ' customers with >1 order, ' || CAST(rep_occ AS VARCHAR) || ' with >1 purchase day'", src),
    ]


def _u(parts):
    return sql("\nUNION ALL\n".join(parts))


ORACLE["qua1"] = _u(_pk())
ORACLE["qua2"] = _u(_req())
ORACLE["qua3"] = ORACLE["joi9"] = ORACLE["set3"] = _u(_fk())
ORACLE["qua4"] = _u(_txq())
ORACLE["qua5"] = ORACLE["qua6"] = _u(_rec())
ORACLE["qua7"] = _u(_tmp())
ORACLE["qua8"] = _u(_idn())
ORACLE["qua9"] = _u(_pk() + _req() + _fk() + _txq() + _rec() + _tmp() + _idn())
ORACLE["joi8"] = sql("""
SELECT rows_before, rows_after, CASE WHEN rows_before = rows_after THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT count(*) AS rows_before FROM c_items i JOIN c_orders o ON i.order_id = o.order_id
      JOIN c_customers c ON o.customer_id = c.customer_id) CROSS JOIN (SELECT count(*) AS rows_after FROM tx)""")


# ---------------------------------------------------------------- slices
@o("fil13")
def _fil13():
    return sql(f"SELECT {OM_COLS} FROM om WHERE customer_state IN ('NATION_1', 'NATION_2', 'NATION_3') "
               "AND order_purchase_timestamp >= TIMESTAMP '2000-01-01 00:00:00' "
               "AND order_purchase_timestamp <= TIMESTAMP '2000-06-30 00:00:00'")


SLICE = ("(SELECT * FROM om WHERE customer_state IN ('NATION_1', 'NATION_2', 'NATION_3') "
         "AND order_purchase_timestamp >= TIMESTAMP '2000-01-01 00:00:00' "
         "AND order_purchase_timestamp <= TIMESTAMP '2000-06-30 00:00:00')")


@o("agg4_slice")
def _agg4_slice():
    return _agg4(SLICE)


@o("agg5_slice")
def _agg5_slice():
    return sql(f"""
SELECT order_month, {rnd('sum(order_revenue)', 'revenue')}, count(*) AS orders,
       count(DISTINCT customer_unique_id) AS customers, {rnd('avg(order_revenue)', 'aov')},
       {rnd('avg(review_score)', 'avg_review')}, {rnd('avg(CAST(delivered_late AS DOUBLE)) * 100.0', 'late_rate')},
       {rnd('sum(order_revenue) / count(DISTINCT customer_unique_id)', 'revenue_per_customer')}
FROM {SLICE} GROUP BY order_month""")


@o("agg8_slice")
def _agg8_slice():
    return _agg8(SLICE)


@o("fil14")
def _fil14():
    return sql(f"SELECT {RFM_COLS}, R, F, M, rfm_score, segment FROM seg "
               "WHERE customer_state IN ('NATION_1', 'NATION_2') AND top_category IN ('economy', 'large')")


@o("fil15")
def _fil15():
    return sql("""
SELECT 'All time' AS preset, lo AS date_start, hi AS date_end FROM (SELECT min(order_purchase_timestamp) lo, max(order_purchase_timestamp) hi FROM om)
UNION ALL SELECT 'Last 3 months', hi - INTERVAL 90 DAY, hi FROM (SELECT max(order_purchase_timestamp) hi FROM om)
UNION ALL SELECT 'Last 6 months', hi - INTERVAL 182 DAY, hi FROM (SELECT max(order_purchase_timestamp) hi FROM om)
UNION ALL SELECT 'Last 12 months', hi - INTERVAL 365 DAY, hi FROM (SELECT max(order_purchase_timestamp) hi FROM om)
UNION ALL SELECT 'Custom', TIMESTAMP '2000-01-01 00:00:00', TIMESTAMP '2000-03-31 00:00:00' + INTERVAL 1 DAY""")


@o("fil16")
def _fil16():
    return sql("SELECT DISTINCT 'customer_state' AS dimension, CAST(customer_state AS VARCHAR) AS value FROM om "
               "WHERE customer_state IS NOT NULL UNION ALL SELECT DISTINCT 'top_category', top_category FROM om "
               "WHERE top_category IS NOT NULL")


@o("fil17")
def _fil17():
    return sql(f"SELECT customer_unique_id, {rnd('monetary', 'monetary')}, frequency FROM rfm "
               "WHERE CAST(customer_unique_id AS VARCHAR) = '42' OR starts_with(CAST(customer_unique_id AS VARCHAR), '13')")


# ---------------------------------------------------------------- dashboard
SEG_SCORES = (f"(SELECT s.*, g.segment FROM {SCORES} s LEFT JOIN seg g ON s.key = g.customer_unique_id)")


@o("agg24")
def _agg24():
    return sql(f"""
SELECT customers, {rnd('100.0 * champions / customers', 'pct_champions')},
       {rnd('100.0 * hibernating / customers', 'pct_hibernating')},
       {rnd('100.0 * hib_rev / revenue', 'pct_revenue_hibernating')}, new_customers
FROM (SELECT count(*) AS customers, sum(monetary) AS revenue, count(*) FILTER (WHERE segment = 'Champions') AS champions,
             count(*) FILTER (WHERE segment = 'Hibernating') AS hibernating,
             coalesce(sum(monetary) FILTER (WHERE segment = 'Hibernating'), 0.0) AS hib_rev,
             count(*) FILTER (WHERE segment = 'New') AS new_customers FROM seg)""")


@o("agg25", "joi15")
def _agg25():
    return sql(f"""
SELECT segment, count(*) AS customers, {rnd('avg(p)', 'mean_pred')}, {rnd('sum(p)', 'total_pred')},
       {rnd('avg(y)', 'mean_actual')}, count(*) FILTER (WHERE y > 0) AS returned,
       {rnd('100.0 * count(*) FILTER (WHERE y > 0) / count(*)', 'return_rate')}
FROM {SEG_SCORES} WHERE segment IS NOT NULL GROUP BY segment""")


@o("agg26")
def _agg26():
    return sql(f"SELECT count(*) AS customers, {rnd('sum(p)', 'sum_scores')}, {rnd('sum(y)', 'total_actual')}, "
               f"count(*) FILTER (WHERE y > 0) AS returned FROM {SCORES}")


@o("agg27")
def _agg27():
    return sql(f"""
SELECT q.segment, q.n, {rnd('q.q1', 'q1')}, {rnd('q.median', 'median')}, {rnd('q.q3', 'q3')}, {rnd('q.mn', 'min')},
       {rnd('q.mx', 'max')}, {rnd('w.lw', 'lower_whisker')}, {rnd('w.uw', 'upper_whisker')}
FROM (SELECT segment, count(*) AS n, quantile_cont(p, 0.25) AS q1, quantile_cont(p, 0.5) AS median,
             quantile_cont(p, 0.75) AS q3, min(p) AS mn, max(p) AS mx FROM {SEG_SCORES} WHERE segment IS NOT NULL GROUP BY 1) q
JOIN (SELECT s.segment, min(s.p) FILTER (WHERE s.p >= b.q1 - 1.5 * (b.q3 - b.q1)) AS lw,
             max(s.p) FILTER (WHERE s.p <= b.q3 + 1.5 * (b.q3 - b.q1)) AS uw
      FROM {SEG_SCORES} s JOIN (SELECT segment, quantile_cont(p, 0.25) AS q1, quantile_cont(p, 0.75) AS q3
                                 FROM {SEG_SCORES} WHERE segment IS NOT NULL GROUP BY 1) b ON s.segment = b.segment
      GROUP BY s.segment) w ON q.segment = w.segment""")


@o("agg28")
def _agg28():
    return sql(f"""
SELECT segment, 'stats' AS kind, CAST(NULL AS VARCHAR) AS value, CAST(NULL AS INTEGER) AS rank, count(*) AS customers,
       {rnd('sum(monetary)', 'revenue')}, {rnd('median(monetary)', 'median_spend')}, {rnd('median(recency)', 'median_recency')}
FROM seg GROUP BY segment
UNION ALL
SELECT segment, 'state', CAST(customer_state AS VARCHAR), CAST(rk AS INTEGER), customers, NULL, NULL, NULL FROM (
  SELECT segment, customer_state, count(*) AS customers,
         row_number() OVER (PARTITION BY segment ORDER BY count(*) DESC, customer_state) AS rk
  FROM seg WHERE customer_state IS NOT NULL GROUP BY 1, 2) WHERE rk <= 10
UNION ALL
SELECT segment, 'category', top_category, CAST(rk AS INTEGER), customers, NULL, NULL, NULL FROM (
  SELECT segment, top_category, count(*) AS customers,
         row_number() OVER (PARTITION BY segment ORDER BY count(*) DESC, top_category) AS rk
  FROM seg WHERE top_category IS NOT NULL GROUP BY 1, 2) WHERE rk <= 10""")


def _hist(measure, clip):
    base = (f"(SELECT least(monetary, (SELECT quantile_cont(monetary, 0.99) FROM seg)) AS x FROM seg WHERE monetary IS NOT NULL)"
            if clip else f"(SELECT CAST({measure} AS DOUBLE) AS x FROM seg WHERE {measure} IS NOT NULL)")
    return f"""
SELECT '{measure}' AS measure, bin, {rnd('lo + (bin - 1) * (hi - lo) / 50', 'lo')}, {rnd('lo + bin * (hi - lo) / 50', 'hi')},
       count(*) AS count
FROM (SELECT CASE WHEN hi = lo THEN 1 ELSE least(CAST(floor((x - lo) / ((hi - lo) / 50)) AS INTEGER) + 1, 50) END AS bin, lo, hi
      FROM {base} b CROSS JOIN (SELECT min(x) AS lo, max(x) AS hi FROM {base}) r)
GROUP BY bin, lo, hi"""


ORACLE["agg29"] = sql(_hist("monetary", True) + "\nUNION ALL\n" + _hist("recency", False))


@o("agg33")
def _agg33():
    cats = ("top_category", "customer_state", "payment_type")
    cols = [(f"CAST(0.0 AS DOUBLE) AS {f}" if f in cats else rnd(f"coalesce(median({f}), 0.0)", f)) for f in FEATURES]
    return sql(f"SELECT {', '.join(cols)} FROM panel WHERE split = 'test'")


# ---------------------------------------------------------------- sources / sinks
@o("src1")
def _src1():
    return sql("SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id, order_status, "
               "order_purchase_timestamp, order_approved_at, order_delivered_carrier_date, order_delivered_customer_date, "
               "order_estimated_delivery_date FROM r_orders")


@o("src2")
def _src2():
    names = [("customers", "r_customers"), ("orders", "r_orders"), ("order_items", "r_items"),
             ("order_payments", "r_payments"), ("order_reviews", "r_reviews"), ("products", "r_products"),
             ("sellers", "r_sellers"), ("category_translation", "r_translation"), ("geolocation", "r_geolocation")]
    return sql("\nUNION ALL\n".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {c}" for n, c in names))


@o("src4")
def _src4():
    return "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'F'"


@o("snk1")
def _snk1():
    return sql(f"SELECT {OM_COLS} FROM om")


@o("snk2")
def _snk2():
    return sql(f"""
SELECT order_id, customer_unique_id, order_purchase_timestamp, order_month,
       {rnd('CAST(order_revenue AS FLOAT)', 'order_revenue')}, CAST(n_items AS INTEGER) AS n_items,
       {rnd('CAST(review_score AS FLOAT)', 'review_score')}, delivered_late,
       {rnd('CAST(delivery_days AS FLOAT)', 'delivery_days')}, customer_state, top_category, payment_type FROM om""")


@o("snk3")
def _snk3():
    return sql("""
SELECT 'aov' AS key, printf('%.6f', aov) AS value FROM thresholds
UNION ALL SELECT 'monetary_cut_low', printf('%.6f', monetary_cut_low) FROM thresholds
UNION ALL SELECT 'monetary_cut_high', printf('%.6f', monetary_cut_high) FROM thresholds
UNION ALL SELECT 'recency_cuts', '90,180,365'
UNION ALL SELECT 'snapshot_date', strftime(snapshot, '%Y-%m-%d') FROM snap
UNION ALL SELECT 'total_revenue', printf('%.6f', sum(order_revenue)) FROM om
UNION ALL SELECT 'n_customers', CAST(count(DISTINCT customer_unique_id) AS VARCHAR) FROM om
UNION ALL SELECT 'n_orders', CAST(count(*) AS VARCHAR) FROM om""")


# ---------------------------------------------------------------- models
@o("agg32")
def _agg32():
    ot = f"TIMESTAMP '{P.test_origin} 00:00:00'"
    return sql(f"""
SELECT n, CASE WHEN n >= 30 THEN {rnd('r', 'x')[:-5]} END AS corr,
       CASE WHEN n < 30 THEN 'untestable' WHEN abs(r) < 0.1 THEN 'OK' WHEN abs(r) > 0.3 THEN 'VIOLATED' ELSE 'marginal' END AS verdict
FROM (SELECT count(*) AS n, corr(CAST(frequency AS DOUBLE), monetary_value) AS r FROM (
  SELECT customer_unique_id, count(*) - 1 AS frequency,
         CASE WHEN count(*) > 1 THEN (sum(rev) - arg_min(rev, day)) / (count(*) - 1) ELSE 0.0 END AS monetary_value
  FROM (SELECT customer_unique_id, CAST(order_purchase_timestamp AS DATE) AS day, sum(order_revenue) AS rev
        FROM om WHERE order_purchase_timestamp < {ot} GROUP BY 1, 2)
  GROUP BY customer_unique_id) WHERE frequency > 0 AND monetary_value > 0)""")


@o("fea7")
def _fea7():
    rows = []
    bound = {"train": P.valid_origin or P.test_origin, "valid": P.test_origin, "test": None}
    for s, org in ORIGINS_:
        b = f"TIMESTAMP '{bound[s]} 00:00:00'" if bound[s] else "CAST(NULL AS TIMESTAMP)"
        rows.append(f"SELECT '{s}' AS split, TIMESTAMP '{org} 00:00:00' AS origin, {b} AS must_close_by")
    dim = " UNION ALL ".join(rows)
    return sql(f"""
SELECT d.split, d.origin, d.must_close_by, d.origin + INTERVAL {P.horizon_days} DAY AS window_end,
       coalesce(d.origin + INTERVAL {P.horizon_days} DAY <= d.must_close_by, true) AS ok,
       (SELECT count(*) FROM om WHERE order_purchase_timestamp >= d.origin
          AND order_purchase_timestamp < d.origin + INTERVAL {P.horizon_days} DAY) AS orders_in_window
FROM ({dim}) d""")


@o("srt1")
def _srt1():
    return sql(f"SELECT {TX_COLS} FROM tx ORDER BY order_purchase_timestamp, order_id, order_item_id")


# Adapter output types (Spark names) for the profile's dtype column.
_RAW_TYPES = {
    "customers": [("customer_id", "bigint"), ("customer_unique_id", "bigint"), ("customer_zip_code_prefix", "int"),
                  ("customer_city", "string"), ("customer_state", "string")],
    "orders": [("order_id", "bigint"), ("customer_id", "bigint"), ("order_status", "string"),
               ("order_purchase_timestamp", "timestamp_ntz"), ("order_approved_at", "timestamp_ntz"),
               ("order_delivered_carrier_date", "timestamp_ntz"), ("order_delivered_customer_date", "timestamp_ntz"),
               ("order_estimated_delivery_date", "timestamp_ntz")],
    "order_items": [("order_id", "bigint"), ("order_item_id", "smallint"), ("product_id", "bigint"),
                    ("seller_id", "bigint"), ("shipping_limit_date", "timestamp_ntz"), ("price", "double"),
                    ("freight_value", "double")],
    "order_payments": [("order_id", "bigint"), ("payment_sequential", "smallint"), ("payment_type", "string"),
                       ("payment_installments", "smallint"), ("payment_value", "double")],
    "order_reviews": [("review_id", "string"), ("order_id", "bigint"), ("review_score", "tinyint"),
                      ("review_creation_date", "timestamp_ntz"), ("review_answer_timestamp", "timestamp_ntz")],
    "products": [("product_id", "bigint"), ("product_category_name", "string")],
    "sellers": [("seller_id", "bigint"), ("seller_zip_code_prefix", "int"), ("seller_state", "string")],
    "category_translation": [("product_category_name", "string"), ("product_category_name_english", "string")],
    "geolocation": [("geolocation_zip_code_prefix", "int"), ("geolocation_lat", "double"), ("geolocation_lng", "double"),
                    ("geolocation_city", "string"), ("geolocation_state", "string")],
}
_RAW_CTE = {"customers": "r_customers", "orders": "r_orders", "order_items": "r_items", "order_payments": "r_payments",
            "order_reviews": "r_reviews_full", "products": "r_products", "sellers": "r_sellers",
            "category_translation": "r_translation", "geolocation": "r_geolocation"}
_PKS = {"customers": ["customer_id"], "orders": ["order_id"], "order_items": ["order_id", "order_item_id"],
        "order_payments": ["order_id", "payment_sequential"], "products": ["product_id"], "sellers": ["seller_id"],
        "category_translation": ["product_category_name"]}


@o("src3")
def _src3():
    parts = []
    for t, cols in _RAW_TYPES.items():
        src = _RAW_CTE[t]
        pk = _PKS.get(t)
        dup = (f"(SELECT count(*) - count(DISTINCT ({', '.join(pk)})) FROM {src})" if pk else "CAST(NULL AS BIGINT)")
        for c, dt in cols:
            parts.append(
                f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{dt}' AS dtype, count(*) AS n_rows, "
                f"count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
                f"{rnd(f'100.0 * count(*) FILTER (WHERE {c} IS NULL) / nullif(count(*), 0)', 'null_pct')}, "
                f"count(DISTINCT {c}) AS n_distinct, {dup} AS pk_duplicates FROM {src}")
    return sql("\nUNION ALL\n".join(parts))


def _given_cte() -> str:
    """Predictions under the registry's given parameters: the BG/NBD conditional
    expectation with its hypergeometric series summed term by term."""
    from patronage.registry import GIVEN as G
    ot, h = f"TIMESTAMP '{P.test_origin} 00:00:00'", float(P.horizon_days)
    life = (f"SELECT customer_unique_id, CAST(count(*) - 1 AS BIGINT) AS frequency, "
            f"date_diff('microsecond', CAST(min(day) AS TIMESTAMP), CAST(max(day) AS TIMESTAMP)) / 86400000000.0 AS recency, "
            f"date_diff('microsecond', CAST(min(day) AS TIMESTAMP), {ot}) / 86400000000.0 AS \"T\", "
            f"CASE WHEN count(*) > 1 THEN (sum(rev) - arg_min(rev, day)) / (count(*) - 1) ELSE 0.0 END AS monetary_value, "
            f"sum(rev) / sum(n) AS observed_aov "
            f"FROM (SELECT customer_unique_id, CAST(order_purchase_timestamp AS DATE) AS day, sum(order_revenue) AS rev, count(*) AS n "
            f"FROM om WHERE order_purchase_timestamp < {ot} GROUP BY 1, 2) GROUP BY customer_unique_id")
    r, al, a, b = G["r"], G["alpha"], G["a"], G["b"]
    series = (f"(SELECT sum(exp(lgamma({r} + x + k) - lgamma({r} + x) + lgamma({b} + x + k) - lgamma({b} + x) "
              f"- lgamma({a + b - 1} + x + k) + lgamma({a + b - 1} + x) - lgamma(k + 1) + k * ln(z))) FROM range(0, 400) AS s(k))")
    return f"""(SELECT *, expected_purchases * expected_value AS pred_bgnbd, expected_purchases * observed_aov AS pred_bgnbd_empirical FROM (
SELECT *, ({a + b - 1} + x) / {a - 1} * (1 - pow(({al} + "T") / ({al} + "T" + {h}), {r} + x) * {series})
  / (1 + CASE WHEN x > 0 THEN {a} / ({b} + x - 1) * pow(({al} + "T") / ({al} + recency), {r} + x) ELSE 0 END) AS expected_purchases,
  {G['gg_p']} * ({G['gg_v']} + x * monetary_value) / ({G['gg_p']} * x + {G['gg_q']} - 1) AS expected_value
FROM (SELECT *, CAST(frequency AS DOUBLE) AS x, {h} / ({al} + "T" + {h}) AS z FROM ({life}))))"""


@o("mod2_given", "mod5_given", "joi17_given")
def _mod2_given():
    cols = ", ".join(rnd(f'"{c}"', f'"{c}"') for c in ("recency", "T", "monetary_value", "expected_purchases", "expected_value",
                                                     "pred_bgnbd", "pred_bgnbd_empirical"))
    return sql(f"SELECT customer_unique_id, frequency, {cols} FROM {_given_cte()}")


@o("mod6_given", "mod4_given")
def _mod6_given():
    from patronage.operators.models import mean_spend_status
    from patronage.registry import GIVEN
    note = mean_spend_status(GIVEN["gg_q"])[1].replace("'", "''")
    return sql(f"""SELECT count(*) AS n_customers, count(*) FILTER (WHERE frequency > 0) AS n_frequency_gt0,
{rnd('100.0 * count(*) FILTER (WHERE frequency > 0) / count(*)', 'pct_frequency_gt0')},
{rnd('min(expected_purchases)', 'expected_purchases_min')}, {rnd('max(expected_purchases)', 'expected_purchases_max')},
{rnd('min(expected_value)', 'expected_value_min')}, count(*) FILTER (WHERE expected_value < 0) AS n_negative_expected_value,
count(*) FILTER (WHERE pred_bgnbd < 0) AS n_negative_predictions, '{note}' AS gg_validity_note FROM {_given_cte()}""")


@o("joi13_given", "joi14_given")
def _joi13_given():
    feats = ", ".join(rnd(f"p.{c}", c) if c in _DOUBLE_FEATS else f"p.{c}" for c in (
        "recency", "frequency", "monetary", "tenure", "aov", "customer_state", "top_category"))
    return sql(f"""SELECT p.customer_unique_id, {rnd('p.target', 'actual_90d_spend')},
{rnd('coalesce(g.pred_bgnbd, 0.0)', 'pred_bgnbd')}, {rnd('coalesce(g.pred_bgnbd_empirical, 0.0)', 'pred_bgnbd_empirical')}, {feats}
FROM (SELECT * FROM panel WHERE split = 'test') p LEFT JOIN (SELECT * FROM {_given_cte()} WHERE customer_unique_id % 3 <> 0) g
ON g.customer_unique_id = p.customer_unique_id""")


@o("snk1_analytics")
def _snk1_analytics():
    tables = {"kpis": "agg4", "monthly_trend": "agg5", "states": "agg8", "category_monthly": "agg9",
              "repurchase_curve": "agg13", "segments": "rfm2", "segment_summary": "agg14", "thresholds": "agg12",
              "frequency_impact": "agg15", "cohort_sizes": "agg17", "cohort_retention": "agg18",
              "cohort_cumulative": "agg19", "cohort_revenue": "agg20", "cohort_summary": "agg21",
              "export_orders": "snk2", "export_segments": "rfm2", "meta": "snk3", "categories": "agg7"}
    return "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, (SELECT count(*) FROM ({ORACLE[q]})) AS n_rows"
                                for t, q in tables.items())
