"""Dashboard slicing: filters, presets, dimension lists, customer lookup (FIL13-FIL17)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.config import CUSTOMER_KEY, DATE_PRESETS
from patronage.functions.columns import add_days, ntz

TS = "order_purchase_timestamp"


@dataclass(frozen=True)
class Filters:
    """Shared filter state: inclusive date range, states, categories (empty = all)."""

    date_start: str | None = None
    date_end: str | None = None
    states: tuple[str, ...] = ()
    categories: tuple[str, ...] = ()

    @property
    def is_active(self) -> bool:
        return bool(self.states or self.categories)


def _dims(f: Filters, columns: list[str]) -> list[Column]:
    preds = []
    if f.states and "customer_state" in columns:
        preds.append(F.col("customer_state").isin(list(f.states)))
    if f.categories and "top_category" in columns:
        preds.append(F.col("top_category").isin(list(f.categories)))
    return preds


def apply_filters(orders: DataFrame, f: Filters) -> DataFrame:
    """FIL13: inclusive date range AND state IN AND category IN (empty lists pass)."""
    preds = _dims(f, orders.columns)
    if f.date_start:
        preds.append(F.col(TS) >= ntz(f.date_start))
    if f.date_end:
        preds.append(F.col(TS) <= ntz(f.date_end))
    return orders.where(reduce(lambda a, b: a & b, preds)) if preds else orders


def filter_customers(df: DataFrame, f: Filters) -> DataFrame:
    """FIL14: dimension filters only, each applied only if the column exists."""
    preds = _dims(f, df.columns)
    return df.where(reduce(lambda a, b: a & b, preds)) if preds else df


def date_presets(orders: DataFrame, custom: tuple[str, str] | None = None) -> DataFrame:
    """FIL15: resolved ranges — All time = [min, max]; last N days back from max;
    custom = [d0, d1 + 1 day]."""
    mm = orders.agg(F.min(TS).alias("lo"), F.max(TS).alias("hi"))
    rows = [F.struct(F.lit("All time").alias("preset"), F.col("lo").alias("date_start"), F.col("hi").alias("date_end"))]
    for name, days in DATE_PRESETS:
        rows.append(F.struct(F.lit(name).alias("preset"), add_days("hi", -days).alias("date_start"),
                             F.col("hi").alias("date_end")))
    if custom:
        rows.append(F.struct(F.lit("Custom").alias("preset"), ntz(custom[0]).alias("date_start"),
                             add_days(ntz(custom[1]), 1).alias("date_end")))
    return mm.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def dimension_values(orders: DataFrame, columns=("customer_state", "top_category")) -> DataFrame:
    """FIL16: distinct non-null values per dimension, ascending."""
    parts = [orders.select(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value"))
             .where(F.col("value").isNotNull()).distinct() for c in columns]
    return reduce(DataFrame.unionByName, parts).orderBy("dimension", "value")


def lookup_customers(customers: DataFrame, exact: str | None = None, prefix: str | None = None) -> DataFrame:
    """FIL17: by exact id or id prefix."""
    key = F.col(CUSTOMER_KEY).cast("string")
    preds = []
    if exact is not None:
        preds.append(key == F.lit(exact))
    if prefix is not None:
        preds.append(key.startswith(prefix))
    return customers.where(reduce(lambda a, b: a | b, preds)) if preds else customers


def random_customer(customers: DataFrame, seed: int) -> DataFrame:
    """FIL17: a seeded draw of one customer — smallest hash of (id, seed), so the
    same draw on any partitioning (``rand`` would depend on the layout)."""
    return customers.orderBy(F.xxhash64(F.col(CUSTOMER_KEY), F.lit(seed)), F.col(CUSTOMER_KEY)).limit(1)
