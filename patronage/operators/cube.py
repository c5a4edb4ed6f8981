"""A slice cube: the dashboard's figures for any filter from two prepared tables
(AGG4, AGG5, AGG8 under FIL13, FIL14).

``cells`` holds sums for each (day, state, category), ``members`` the customers
of each cell as bitmaps over dense customer numbers. Sums merge by adding,
bitmaps by ``or``, so every slice has exact distinct counts, and answering one
reads no order. Customers are numbered in the order of their least state,
least category and first day, so that a cell's customers stand close together
and its bitmaps are few.

Filters hold whole dates. The end of a range is its midnight (as in
``slices.apply_filters``), so cells tell orders at midnight from later ones.
Customer keys are not null after cleaning; states, categories and measures may
be. An empty slice has the same result as the direct queries on no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.config import CUSTOMER_KEY
from patronage.functions.columns import pct, safe_div
from patronage.operators.metrics import KPI_NAMES
from patronage.operators.slices import TS, Filters, filter_customers
from patronage.plans.joins import with_one_row
from patronage.plans.ranking import global_rank
from patronage.session import materialize

CELL = ("order_date", "at_midnight", "customer_state", "top_category")
MEASURES = {"revenue": "order_revenue", "items": "n_items", "review": "review_score", "late": "delivered_late"}
#: Bits of a day's number (days since 1970): enough until the year 2149.
DAY_BITS = 16


@dataclass
class Cube:
    """``cells``: CELL, n_orders and a sum and a count of each measure.
    ``members``: CELL, bucket and the bitmap of its customers."""
    cells: DataFrame
    members: DataFrame

    def write(self, path: str) -> None:
        for name in ("cells", "members"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")


def read_cube(spark: SparkSession, path: str) -> Cube:
    return Cube(*[spark.read.parquet(f"{path.rstrip('/')}/{name}") for name in ("cells", "members")])


def _celled(orders: DataFrame) -> DataFrame:
    day = F.to_date(TS)
    return orders.select(
        CUSTOMER_KEY, day.alias("order_date"), (F.col(TS) == day.cast("timestamp_ntz")).alias("at_midnight"),
        "customer_state", "top_category", *[F.col(c).cast("double").alias(m) for m, c in MEASURES.items()])


def build_cube(orders: DataFrame) -> Cube:
    """The cube of an order mart, both tables written, sorted by day.

    Orders are added up in their tasks before anything moves: a customer with a
    third of all orders is at most one row for each cell."""
    rows = _celled(orders)
    sums = [F.sum(m).alias(f"sum_{m}") for m in MEASURES] + [F.count(m).alias(f"n_{m}") for m in MEASURES]
    cells = rows.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n_orders"), *sums)
    pairs = materialize(rows.select(CUSTOMER_KEY, *CELL).distinct())
    home = pairs.groupBy(CUSTOMER_KEY).agg(F.min("customer_state").alias("s"), F.min("top_category").alias("c"),
                                           F.min("order_date").alias("d"))
    numbered = global_rank(home, [F.col(c).asc() for c in ("s", "c", "d", CUSTOMER_KEY)], "number") \
        .select(CUSTOMER_KEY, F.bitmap_bucket_number("number").alias("bucket"),
                F.bitmap_bit_position("number").alias("position"))
    members = pairs.join(numbered, CUSTOMER_KEY).groupBy("bucket", *CELL) \
        .agg(F.bitmap_construct_agg("position").alias("customers"))
    return Cube(materialize(cells.sort("order_date")), materialize(members.sort("order_date", "bucket")))


def _sliced(table: DataFrame, f: Filters) -> DataFrame:
    """The cells of a filter; raises ValueError where a bound is not a whole date."""
    preds = []
    if f.date_start:
        preds.append(F.col("order_date") >= F.lit(date.fromisoformat(f.date_start)))
    if f.date_end:
        end = F.lit(date.fromisoformat(f.date_end))
        preds += [F.col("order_date") <= end, (F.col("order_date") < end) | F.col("at_midnight")]
    out = filter_customers(table, f)
    return out.where(reduce(lambda a, b: a & b, preds)) if preds else out


def _mean(measure: str) -> Column:
    return F.try_divide(F.sum(f"sum_{measure}"), F.sum(f"n_{measure}"))


def _counted(members: DataFrame, *by: str) -> DataFrame:
    """Distinct customers for each value of ``by``: bitmaps merged in each bucket, then counted."""
    merged = members.groupBy("bucket", *by).agg(F.bitmap_count(F.bitmap_or_agg("customers")).alias("n"))
    return merged.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("customers"))


def repeat_customers(members: DataFrame) -> DataFrame:
    """One row: n, the customers seen on two days or more.

    Two days differ in some bit of their numbers. So a customer has two days if,
    for some bit, it is in the union of the days with the bit set and in the
    union of those without: unions, an intersection and a union again, all of
    them mergeable, and no list of a customer's days."""
    bits = F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(DAY_BITS - 1)),
        lambda k: F.struct(k.alias("bit"), F.call_function("getbit", F.unix_date("order_date"), k).alias("side"))))
    days = members.groupBy("bucket", "order_date").agg(F.bitmap_or_agg("customers").alias("customers"))
    sides = days.select("bucket", "customers", bits.alias("b")).groupBy("bucket", "b.bit", "b.side") \
        .agg(F.bitmap_or_agg("customers").alias("customers"))
    both = sides.groupBy("bucket", "bit").agg(F.bitmap_and_agg("customers").alias("customers"),
                                              F.count(F.lit(1)).alias("n")).where("n = 2")
    merged = both.groupBy("bucket").agg(F.bitmap_count(F.bitmap_or_agg("customers")).alias("n"))
    return merged.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def headline(cube: Cube, f: Filters) -> DataFrame:
    """AGG4 of a slice, as ``metrics.headline_metrics`` of the filtered orders."""
    members = _sliced(cube.members, f)
    one = _sliced(cube.cells, f).agg(
        F.coalesce(F.sum("n_orders"), F.lit(0)).alias("n_orders"), F.sum("sum_revenue").alias("total_revenue"),
        _mean("revenue").alias("aov"), _mean("items").alias("avg_items_per_order"),
        _mean("review").alias("avg_review_score"), (_mean("late") * 100.0).alias("late_delivery_rate"))
    one = with_one_row(with_one_row(one, _counted(members).withColumnRenamed("customers", "n_customers")),
                       repeat_customers(members).withColumnRenamed("n", "repeaters"))
    one = one.withColumns({"revenue_per_customer": safe_div("total_revenue", "n_customers"),
                           "repeat_purchase_rate": F.try_divide(F.col("repeaters") * 100.0, F.col("n_customers"))})
    return one.select(*[
        F.col(n).cast("long").alias(n) if n in ("n_orders", "n_customers")
        else F.when(F.col("n_orders") == 0, 0.0).otherwise(F.col(n).cast("double")).alias(n) for n in KPI_NAMES])


def states(cube: Cube, f: Filters) -> DataFrame:
    """AGG8 of a slice, as ``metrics.state_breakdown`` of the filtered orders."""
    known = F.col("customer_state").isNotNull()
    st = _sliced(cube.cells, f).where(known).groupBy("customer_state").agg(
        F.sum("sum_revenue").alias("revenue"), F.sum("n_orders").alias("orders"), _mean("revenue").alias("aov"),
        _mean("review").alias("avg_review"))
    st = st.join(_counted(_sliced(cube.members, f).where(known), "customer_state"), "customer_state")
    total = st.agg(F.sum("revenue").alias("__total"))
    return with_one_row(st, total).select(
        "customer_state", "revenue", "orders", "customers", "aov", "avg_review",
        pct("revenue", "__total").alias("pct_revenue")).orderBy(F.desc("revenue"), "customer_state")


def months(cube: Cube, f: Filters) -> DataFrame:
    """AGG5 of a slice by month, but for the split into new and returning
    customers (AGG6), which needs each customer's orders."""
    month = F.trunc("order_date", "MM").alias("order_month")
    t = _sliced(cube.cells, f).groupBy(month).agg(
        F.sum("sum_revenue").alias("revenue"), F.sum("n_orders").alias("orders"), _mean("revenue").alias("aov"),
        _mean("review").alias("avg_review"), (_mean("late") * 100.0).alias("late_rate"))
    n = _counted(_sliced(cube.members, f).withColumn("order_month", month), "order_month")
    return t.join(n, "order_month").withColumn("revenue_per_customer", F.col("revenue") / F.col("customers")) \
        .orderBy("order_month")
