"""Cohort retention in long form (AGG16-AGG21, WIN4).

A cohort is the month of a customer's first purchase; ``month_index`` is the
whole-month offset of an order from it. Matrices are long
``(cohort_month, month_index, value)``; cells the reference leaves NaN
(unobservable, or — for plain retention — months without activity) are
omitted. ``to_wide`` pivots with an explicit column list at the sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from patronage.config import CUSTOMER_KEY
from patronage.functions.columns import month_index, month_start
from patronage.plans.joins import with_one_row

TS = "order_purchase_timestamp"


def customer_cohorts(orders: DataFrame) -> DataFrame:
    """(customer, cohort_month): a partial aggregation, skew-safe."""
    return orders.groupBy(CUSTOMER_KEY).agg(month_start(F.min(TS)).alias("cohort_month"))


def build_cohort_table(orders: DataFrame) -> DataFrame:
    """AGG16: orders with cohort_month and month_index."""
    o = orders.join(customer_cohorts(orders), CUSTOMER_KEY, "inner")
    return o.withColumn("month_index", month_index("order_month", "cohort_month"))


def cohort_sizes(orders: DataFrame) -> DataFrame:
    """AGG17: customers per cohort (each customer belongs to exactly one)."""
    return customer_cohorts(orders).groupBy("cohort_month").agg(F.count(F.lit(1)).alias("customers"))


def _observable(orders: DataFrame, df: DataFrame) -> DataFrame:
    last = orders.agg(F.max("order_month").alias("__last"))
    return with_one_row(df, last).where(F.col("month_index") <= month_index("__last", "cohort_month")) \
        .drop("__last")


def retention_matrix(orders: DataFrame) -> DataFrame:
    """AGG18: % of the cohort active in month N (observed, non-empty cells)."""
    c = build_cohort_table(orders)
    active = c.groupBy("cohort_month", "month_index").agg(F.count_distinct(CUSTOMER_KEY).alias("active"))
    m = active.join(cohort_sizes(orders), "cohort_month", "inner") \
        .withColumn("pct", F.lit(100.0) * F.col("active") / F.col("customers"))
    return _observable(orders, m).select("cohort_month", "month_index", "active", "customers", "pct")


def _grid_cumsum(orders: DataFrame, counts: DataFrame, value: str, months: DataFrame) -> DataFrame:
    """Cohorts × months grid, zero-filled, running sum over month_index (WIN4).

    Both axes are bounded by the number of calendar months, so the grid and
    its window are tiny whatever the data size.
    """
    sizes = cohort_sizes(orders)
    axis = months.agg(F.array_sort(F.collect_set("month_index")).alias("__months"))  # calendar-bounded
    grid = with_one_row(sizes, axis).select("cohort_month", "customers", F.explode("__months").alias("month_index")) \
        .join(counts, ["cohort_month", "month_index"], "left") \
        .withColumn(value, F.coalesce(F.col(value), F.lit(0)))
    w = Window.partitionBy("cohort_month").orderBy("month_index").rowsBetween(Window.unboundedPreceding, 0)
    return grid.withColumn("cum_" + value, F.sum(value).over(w))


def first_repeats(orders: DataFrame) -> DataFrame:
    """Per customer: the first month_index > 0 with an order (null if none)."""
    c = build_cohort_table(orders)
    return c.where(F.col("month_index") > 0).groupBy(CUSTOMER_KEY).agg(
        F.min("cohort_month").alias("cohort_month"), F.min("month_index").alias("month_index"))


def cumulative_repeat_matrix(orders: DataFrame) -> DataFrame:
    """AGG19: % of the cohort whose first repeat (month > 0) is at or before N.

    Columns are the month offsets that occur among first repeats (no 0, gaps
    possible); unobservable cells are omitted.
    """
    fr = first_repeats(orders)
    counts = fr.groupBy("cohort_month", "month_index").agg(F.count(F.lit(1)).alias("repeaters"))
    months = fr.select("month_index").distinct()
    g = _grid_cumsum(orders, counts, "repeaters", months)
    g = g.withColumn("pct", F.lit(100.0) * F.col("cum_repeaters") / F.col("customers"))
    return _observable(orders, g).select("cohort_month", "month_index", "customers", "repeaters",
                                         "cum_repeaters", "pct")


def cohort_revenue_matrix(orders: DataFrame) -> DataFrame:
    """AGG20: cumulative revenue per cohort customer by cohort age (month 0 included)."""
    c = build_cohort_table(orders)
    rev = c.groupBy("cohort_month", "month_index").agg(F.sum("order_revenue").alias("revenue"))
    months = c.select("month_index").distinct()
    g = _grid_cumsum(orders, rev, "revenue", months)
    g = g.withColumn("revenue_per_customer", F.col("cum_revenue") / F.col("customers"))
    return _observable(orders, g).select("cohort_month", "month_index", "customers", "revenue",
                                         "cum_revenue", "revenue_per_customer")


def cohort_summary(orders: DataFrame, horizons=(3, 6, 12)) -> DataFrame:
    """AGG21: per cohort size, revenue, revenue/customer, repeat % by month h."""
    c = build_cohort_table(orders)
    rev = c.groupBy("cohort_month").agg(F.sum("order_revenue").alias("revenue"))
    cum = cumulative_repeat_matrix(orders).groupBy("cohort_month").agg(
        *[F.max(F.when(F.col("month_index") == h, F.col("pct"))).alias(f"repeat_by_m{h}") for h in horizons])
    s = cohort_sizes(orders).join(rev, "cohort_month", "inner").join(cum, "cohort_month", "left")
    return s.withColumn("revenue_per_customer", F.col("revenue") / F.col("customers")).select(
        "cohort_month", "customers", "revenue", "revenue_per_customer", *[f"repeat_by_m{h}" for h in horizons])


def to_wide(long: DataFrame, value: str, months: list[int]) -> DataFrame:
    """Sink-side pivot with an explicit column list (no extra distinct job)."""
    return long.groupBy("cohort_month").pivot("month_index", months).agg(F.first(value))
