"""Every slice answered from the cube equals the direct query on the filtered orders."""

import random

import pytest
from pyspark.sql import functions as F
from helpers import orders_frame

from patronage.operators import cube as CB
from patronage.operators import metrics as ME
from patronage.operators.slices import Filters, apply_filters

SLICES = [
    Filters(), Filters(states=("S1",)), Filters(categories=("c0", "c2")),
    Filters(date_start="2000-01-20", date_end="2000-03-02"), Filters(date_end="2000-01-05"),
    Filters(date_start="2000-02-01", states=("S0", "S2"), categories=("c1",)),
    Filters(states=("nowhere",)), Filters(date_start="2001-01-01"),
]


@pytest.fixture(scope="module")
def orders(spark):
    rnd, rows = random.Random(4), []
    for i in range(900):
        customer = 0 if i % 3 == 0 else rnd.randrange(1, 250)      # one customer has a third of all orders
        day, hour = rnd.randrange(1, 28), rnd.choice(["00:00:00", "00:00:01", "17:30:00"])
        rows.append((i, customer, f"2000-{rnd.randrange(1, 5):02d}-{day:02d} {hour}", rnd.randrange(1, 900) / 4, {
            "customer_state": rnd.choice(["S0", "S1", "S2", None]), "top_category": rnd.choice(["c0", "c1", "c2", None]),
            "review_score": rnd.choice([None, 1.0, 4.0, 5.0]), "delivered_late": rnd.choice([True, False, None])}))
    return orders_frame(spark, rows)


@pytest.fixture(scope="module")
def cube(orders):
    return CB.build_cube(orders)


def same(got, exp):
    a, b = ([r.asDict() for r in df.collect()] for df in (got, exp))
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert x.keys() == y.keys()
        for k in x:
            assert x[k] == (pytest.approx(y[k]) if isinstance(y[k], float) else y[k]), k


@pytest.mark.parametrize("f", SLICES, ids=str)
def test_slices_equal_direct_queries(orders, cube, f):
    direct = apply_filters(orders, f)
    same(CB.headline(cube, f), ME.headline_metrics(direct))
    same(CB.states(cube, f), ME.state_breakdown(direct))
    names = CB.months(cube, f).columns
    same(CB.months(cube, f), ME.monthly_trend(direct).select(*names))


def test_customers_beyond_one_bucket(spark):
    n = 70_000
    df = spark.range(n).select(
        F.col("id").alias("order_id"), (F.col("id") % 50_000).alias("customer_unique_id"),
        F.expr("timestamp_ntz'2000-01-01 08:00:00' + make_dt_interval(cast(id % 7 as int))")
        .alias("order_purchase_timestamp"), F.lit(1.0).alias("order_revenue"), F.lit(1).alias("n_items"),
        F.lit("cat").alias("top_category"), F.concat(F.lit("S"), F.col("id") % 3).alias("customer_state"),
        F.lit(5.0).alias("review_score"), F.lit(False).alias("delivered_late"))
    cube = CB.build_cube(df)
    assert cube.members.select("bucket").distinct().count() == 2
    for f in (Filters(), Filters(states=("S0", "S1"), date_start="2000-01-02", date_end="2000-01-05")):
        same(CB.headline(cube, f), ME.headline_metrics(apply_filters(df, f)))


def test_a_written_cube_answers_without_orders(spark, orders, cube, tmp_path):
    cube.write(str(tmp_path))
    same(CB.headline(CB.read_cube(spark, str(tmp_path)), SLICES[3]), ME.headline_metrics(apply_filters(orders, SLICES[3])))


def test_empty_orders_and_bounds_with_a_time(spark, orders, cube):
    empty = CB.build_cube(orders.limit(0))
    same(CB.headline(empty, Filters()), ME.headline_metrics(orders.limit(0)))
    assert CB.states(empty, Filters()).count() == 0 and CB.months(empty, Filters()).count() == 0
    with pytest.raises(ValueError):
        CB.headline(cube, Filters(date_end="2000-01-05 12:00:00"))
