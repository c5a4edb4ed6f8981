"""Dashboard aggregates behind the pages (AGG24-AGG29, AGG33, JOI15)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from patronage.config import CUSTOMER_KEY
from patronage.functions.columns import pct
from patronage.plans.joins import with_one_row
from patronage.plans.ranking import group_quantiles


def segment_shares(segmented: DataFrame) -> DataFrame:
    """AGG24: Champions %, Hibernating % of customers and of revenue, New count."""
    one = segmented.agg(
        F.count(F.lit(1)).alias("customers"), F.sum("monetary").alias("revenue"),
        F.count_if(F.col("segment") == "Champions").alias("champions"),
        F.count_if(F.col("segment") == "Hibernating").alias("hibernating"),
        F.sum(F.when(F.col("segment") == "Hibernating", F.col("monetary")).otherwise(0.0)).alias("hib_rev"),
        F.count_if(F.col("segment") == "New").alias("new_customers"))
    return one.select("customers", pct("champions", "customers").alias("pct_champions"),
                      pct("hibernating", "customers").alias("pct_hibernating"),
                      pct("hib_rev", "revenue").alias("pct_revenue_hibernating"), "new_customers")


def scores_with_segments(scores: DataFrame, segmented: DataFrame, key: str = "key") -> DataFrame:
    """JOI15: scores ⟕ segments on the customer key."""
    seg = segmented.select(F.col(CUSTOMER_KEY).alias(key), "segment")
    return scores.join(seg, key, "left")


def score_by_segment(scored: DataFrame) -> DataFrame:
    """AGG25: per segment n, mean/total predicted, mean actual, returned, return rate (by mean_pred desc)."""
    return scored.where(F.col("segment").isNotNull()).groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"), F.avg("p").alias("mean_pred"), F.sum("p").alias("total_pred"),
        F.avg("y").alias("mean_actual"), F.count_if(F.col("y") > 0).alias("returned"),
    ).withColumn("return_rate", F.lit(100.0) * F.col("returned") / F.col("customers")) \
        .orderBy(F.desc("mean_pred"), "segment")


def score_totals(scored: DataFrame) -> DataFrame:
    """AGG26: customers scored, Σ score, Σ actual, # returned."""
    return scored.agg(F.count(F.lit(1)).alias("customers"), F.sum("p").alias("sum_scores"),
                      F.sum("y").alias("total_actual"), F.count_if(F.col("y") > 0).alias("returned"))


def _pivot_quantiles(q: DataFrame, group: str, names: dict[float, str]) -> DataFrame:
    return q.groupBy(group).agg(*[F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(n) for p, n in names.items()])


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """AGG27: quartiles, min/max and 1.5·IQR whiskers per group, ordered by median desc.
    Quartiles are exact (rank-based, distributed)."""
    d = df.where(F.col(group).isNotNull())
    q = _pivot_quantiles(group_quantiles(d, group, value, [0.25, 0.5, 0.75]), group,
                         {0.25: "q1", 0.5: "median", 0.75: "q3"})
    base = d.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("min"), F.max(value).alias("max"))
    j = d.join(q.select(group, "q1", "q3"), group)     # one row per group
    iqr = F.col("q3") - F.col("q1")
    wh = j.groupBy(group).agg(
        F.min(F.when(F.col(value) >= F.col("q1") - 1.5 * iqr, F.col(value))).alias("lower_whisker"),
        F.max(F.when(F.col(value) <= F.col("q3") + 1.5 * iqr, F.col(value))).alias("upper_whisker"))
    return base.join(q, group).join(wh, group).select(group, "n", "q1", "median", "q3", "min", "max",
                                                      "lower_whisker", "upper_whisker").orderBy(F.desc("median"), group)


def segment_drilldown(segmented: DataFrame, top_n: int = 10) -> DataFrame:
    """AGG28: per segment n, revenue, median spend, median recency, and its
    top-``top_n`` states and categories by customers (long form, kind column)."""
    med_s = group_quantiles(segmented, "segment", "monetary", [0.5]).select("segment", F.col("quantile").alias("median_spend"))
    med_r = group_quantiles(segmented, "segment", "recency", [0.5]).select("segment", F.col("quantile").alias("median_recency"))
    stats = segmented.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("monetary").alias("revenue")
    ).join(med_s, "segment", "left").join(med_r, "segment", "left").select("segment", F.lit("stats").alias("kind"), F.lit(None).cast("string").alias("value"),
             F.lit(None).cast("int").alias("rank"), "customers", "revenue", "median_spend", "median_recency")
    parts = [stats]
    for kind, col in (("state", "customer_state"), ("category", "top_category")):
        cnt = segmented.where(F.col(col).isNotNull()).groupBy("segment", col).agg(F.count(F.lit(1)).alias("customers"))
        w = Window.partitionBy("segment").orderBy(F.desc("customers"), F.col(col))  # ≤ #values per segment
        top = cnt.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n)
        parts.append(top.select("segment", F.lit(kind).alias("kind"), F.col(col).cast("string").alias("value"),
                                "rank", "customers", F.lit(None).cast("double").alias("revenue"),
                                F.lit(None).cast("double").alias("median_spend"),
                                F.lit(None).cast("double").alias("median_recency")))
    return reduce(DataFrame.unionByName, parts)


def histogram(df: DataFrame, value: str, bins: int = 50, clip_pct: float | None = 0.99) -> DataFrame:
    """AGG29: ``bins`` equal-width bins of ``value`` (optionally clipped at a
    percentile); (bin, lo, hi, count)."""
    base = df.select(F.col(value).cast("double").alias("x")).where(F.col("x").isNotNull())
    if clip_pct is not None:
        cap = group_quantiles(base, None, "x", [clip_pct]).select(F.col("quantile").alias("__cap"))
        base = with_one_row(base, cap).select(F.least(F.col("x"), F.col("__cap")).alias("x"))
    rng = base.agg(F.min("x").alias("__lo"), F.max("x").alias("__hi"))
    b = with_one_row(base, rng)
    width = (F.col("__hi") - F.col("__lo")) / bins
    idx = F.when(F.col("__hi") == F.col("__lo"), F.lit(1)).otherwise(
        F.least(F.floor((F.col("x") - F.col("__lo")) / width).cast("int") + 1, F.lit(bins)))
    h = b.withColumn("bin", idx).groupBy("bin", "__lo", "__hi").agg(F.count(F.lit(1)).alias("count"))
    w = (F.col("__hi") - F.col("__lo")) / bins
    return h.select(F.lit(value).alias("measure"), "bin", (F.col("__lo") + (F.col("bin") - 1) * w).alias("lo"),
                    (F.col("__lo") + F.col("bin") * w).alias("hi"), "count")


def population_medians(df: DataFrame, names: list[str]) -> DataFrame:
    """AGG33: one row of medians of the named numeric columns (others / missing → 0).

    All features are unpivoted to (feature, value) and ranked once, so every
    median is exact without buffering a column in one task."""
    numeric = [n for n in names if n in {f.name for f in df.schema.fields if f.dataType.typeName() in
               ("double", "float", "integer", "long", "short", "byte", "decimal")}]
    long = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).cast("double").alias("v"))
                                         for n in numeric])).alias("r")).select("r.*")
    med = group_quantiles(long, "feature", "v", [0.5])
    row = med.agg(*[F.max(F.when(F.col("feature") == n, F.col("quantile"))).alias(n) for n in numeric])
    return row.select(*[(F.coalesce(F.col(n), F.lit(0.0)) if n in numeric else F.lit(0.0)).cast("double").alias(n)
                        for n in names])


def aligned_scores(panel_test: DataFrame, preds: DataFrame, key: str = CUSTOMER_KEY) -> DataFrame:
    """JOI13 + JOI14: model predictions aligned to every test customer (missing → 0),
    then joined to the features."""
    return panel_test.join(preds, key, "left").fillna(0.0, subset=[c for c in preds.columns if c != key])
