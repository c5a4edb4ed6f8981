from datetime import datetime, timedelta

from pyspark.sql import functions as F

from patronage.config import TESTDATA_PARAMS as P
from patronage.functions.columns import days_between, month_index, null_safe_gt
from patronage.operators.clean import Ledger, clean_orders, keep_first
from patronage.operators.marts import aggregate_payments


def test_days_between_and_month_index(spark):
    df = spark.createDataFrame([(datetime(2020, 1, 31, 12), datetime(2020, 3, 1, 0))], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(days_between("a", "b").alias("d"), month_index("b", "a").alias("m")).first()
    assert r["d"] == 29.5
    assert r["m"] == 2


def test_late_flag_null_is_false(spark):
    t = datetime(2020, 1, 1)
    df = spark.createDataFrame([(None, t), (t, t), (t + timedelta(microseconds=1), t)],
                               "d timestamp_ntz, e timestamp_ntz")
    got = [r[0] for r in df.select(null_safe_gt("d", "e")).collect()]
    assert got == [False, False, True]


def test_window_upper_bound_inclusive_at_midnight(spark):
    end = datetime.fromisoformat(P.window_end) + timedelta(days=1)
    start = datetime.fromisoformat(P.window_start)
    rows = [(1, 1, "F", start), (2, 1, "F", end), (3, 1, "F", end + timedelta(microseconds=1)),
            (4, 1, "O", start)]
    df = spark.createDataFrame(
        [(a, b, c, d, None, None, None, None) for a, b, c, d in rows],
        "order_id long, customer_id long, order_status string, order_purchase_timestamp timestamp_ntz, "
        "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz")
    led = Ledger()
    kept = sorted(r[0] for r in clean_orders(df, led, P).select("order_id").collect())
    assert kept == [1, 2]
    ledger = {r["reason"]: (r["rows_before"], r["rows_after"]) for r in led.frame().collect()}
    assert ledger["status not in ['F']"] == (4, 3)
    assert ledger[f"outside analysis window {P.window_start}..{P.window_end}"] == (3, 2)


def test_keep_first_is_total_order_and_removes_exact_dups(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", 9.0), (1, "a", 9.0), (2, None, 1.0), (2, "z", 0.0)],
                               "k int, v string, x double")
    got = {r["k"]: (r["v"], r["x"]) for r in keep_first(df, ["k"], ["v", "x"]).collect()}
    assert got == {1: ("a", 9.0), 2: (None, 1.0)}   # nulls first


def test_mode_ties_go_to_smallest_value(spark):
    pay = spark.createDataFrame([(1, 1, "b", 1, 1.0), (1, 2, "a", 1, 1.0), (1, 3, "a", 1, 1.0), (1, 4, "b", 1, 1.0),
                                 (2, 1, None, 1, 1.0), (3, 1, "x", 2, 5.0)],
                                "order_id int, payment_sequential int, payment_type string, "
                                "payment_installments int, payment_value double")
    got = {r["order_id"]: r["payment_type"] for r in aggregate_payments(pay).collect()}
    assert got == {1: "a", 2: None, 3: "x"}
