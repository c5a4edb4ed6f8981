"""Spend concentration: top-share, Gini, Lorenz curve (AGG22, AGG23, RNK3).

All built on the two-pass global rank (no single-partition sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from patronage.config import CUSTOMER_KEY
from patronage.plans.joins import with_one_row
from patronage.plans.ranking import global_rank

TOP_SHARES = (0.01, 0.05, 0.10, 0.20)


def _ranked_desc(customers: DataFrame, value: str) -> DataFrame:
    df = customers.select(CUSTOMER_KEY, value).where(F.col(value).isNotNull())
    return global_rank(df, [F.col(value).desc(), F.col(CUSTOMER_KEY).asc()], "rank")


def top_share(customers: DataFrame, value: str = "monetary", fractions=TOP_SHARES) -> DataFrame:
    """AGG22: % of total held by the top floor(n·f) customers, per fraction."""
    r = _ranked_desc(customers, value)
    n = r.agg(F.count(F.lit(1)).alias("__n"), F.sum(value).alias("__tot"))
    r = with_one_row(r, n)
    aggs = [F.sum(F.when(F.col("rank") <= F.floor(F.col("__n") * f), F.col(value)).otherwise(0.0)).alias(f"s{i}")
            for i, f in enumerate(fractions)]
    one = r.groupBy("__n", "__tot").agg(*aggs)
    rows = [F.struct(F.lit(f).alias("top_fraction"),
                     F.floor(F.col("__n") * f).cast("long").alias("customers"),
                     (F.lit(100.0) * F.col(f"s{i}") / F.col("__tot")).alias("pct_revenue"))
            for i, f in enumerate(fractions)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def gini(customers: DataFrame, value: str = "monetary") -> DataFrame:
    """AGG23: ``2Σ(i·x_i)/(nΣx) − (n+1)/n`` over x ascending."""
    df = customers.select(CUSTOMER_KEY, value).where(F.col(value).isNotNull())
    r = global_rank(df, [F.col(value).asc(), F.col(CUSTOMER_KEY).asc()], "i")
    one = r.agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"),
                F.sum(F.col("i") * F.col(value)).alias("weighted"))
    return one.select("n", (F.lit(2.0) * F.col("weighted") / (F.col("n") * F.col("total"))
                            - (F.col("n") + 1) / F.col("n")).alias("gini"))


def lorenz_curve(customers: DataFrame, value: str = "monetary", points: int = 2000,
                 markers=(5, 20)) -> DataFrame:
    """RNK3: cumulative value % vs customer % (descending), thinned to every
    ``max(n // points, 1)``-th customer, plus marker rows at ``markers`` %.

    Cumulative sums at the kept points come from per-bucket totals (≤ points+1
    buckets): a tiny window, never a running sum over all customers.
    """
    r = _ranked_desc(customers, value)
    n = r.agg(F.count(F.lit(1)).alias("__n"), F.sum(value).alias("__tot"))
    r = with_one_row(r, n).withColumn("__step", F.greatest(F.floor(F.col("__n") / points), F.lit(1)))
    r = r.withColumn("__b", F.floor((F.col("rank") - 1) / F.col("__step")))
    b = r.groupBy("__b", "__n", "__tot", "__step").agg(
        F.sum(value).alias("__bt"), F.min_by(F.col(value), F.col("rank")).alias("__first"),
        F.min("rank").alias("__r0"))
    w = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    curve = b.withColumn("__before", F.coalesce(F.sum("__bt").over(w), F.lit(0.0))).select(
        F.lit("curve").alias("point_type"), F.col("__r0").alias("rank"),
        (F.lit(100.0) * F.col("__r0") / F.col("__n")).alias("customer_share"),
        (F.lit(100.0) * (F.col("__before") + F.col("__first")) / F.col("__tot")).alias("revenue_share"))
    mk_aggs = [F.sum(F.when(F.col("rank") <= F.floor(F.col("__n") * m / 100.0), F.col(value)).otherwise(0.0))
               .alias(f"m{i}") for i, m in enumerate(markers)]
    mk = r.groupBy("__n", "__tot").agg(*mk_aggs)
    rows = [F.struct(F.lit(f"marker_{m}").alias("point_type"),
                     F.floor(F.col("__n") * m / 100.0).cast("long").alias("rank"),
                     F.lit(float(m)).alias("customer_share"),
                     F.when(F.floor(F.col("__n") * m / 100.0) >= 1,
                            F.lit(100.0) * F.col(f"m{i}") / F.col("__tot")).alias("revenue_share"))
            for i, m in enumerate(markers)]
    markers_df = mk.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return curve.unionByName(markers_df)
