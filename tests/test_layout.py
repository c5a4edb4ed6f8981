"""Marts laid out by customer: equal results, no exchange on the customer, plain where a customer is too frequent."""

import pytest
from pyspark.sql import functions as F
from helpers import orders_frame

from patronage.operators import cohorts as CO
from patronage.operators import panel as PN
from patronage.operators import rfm as RF
from patronage.sources.layout import bucketed, largest_share

KEY = "customer_unique_id"
READERS = {"rfm": RF.build_rfm, "cohorts": CO.build_cohort_table, "panel": lambda o: PN.lifetimes_summary(o, "2000-06-01")}


@pytest.fixture(scope="module")
def orders(spark):
    return orders_frame(spark, [(i, (i * 7) % 131, f"2000-0{1 + i % 6}-{1 + i % 28:02d} 10:00:00", i / 4)
                                for i in range(600)])


@pytest.fixture(scope="module")
def table(orders):
    return bucketed(orders, KEY, ["order_purchase_timestamp"], buckets=8)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_table_holds_the_rows(orders, table):
    assert table.columns == orders.columns
    assert table.exceptAll(orders).count() == orders.exceptAll(table).count() == 0


@pytest.mark.parametrize("name", READERS)
def test_readers_need_no_exchange_on_the_customer(orders, table, name):
    got, exp = READERS[name](table), READERS[name](orders)
    assert f"hashpartitioning({KEY}" not in plan(got) and f"hashpartitioning({KEY}" in plan(exp)
    assert sorted(map(str, got.collect())) == sorted(map(str, exp.select(*got.columns).collect()))


def test_a_frequent_customer_keeps_the_table_plain(spark, orders):
    hot = orders.withColumn(KEY, F.when(F.col("order_id") % 3 == 0, F.lit(None)).otherwise(F.col(KEY)))
    assert largest_share(hot, KEY) == pytest.approx(1 / 3)
    out = bucketed(hot, KEY, [], buckets=8)
    assert f"hashpartitioning({KEY}" in plan(RF.build_rfm(out)) and out.count() == 600


def test_no_rows(orders):
    out = bucketed(orders.limit(0), KEY, [], buckets=4)
    assert out.columns == orders.columns and out.count() == 0
