"""Registered queries: SURVEY §2 IDs (lower-case) → ``(spark, sf_dir) -> DataFrame``.

Each reads the driver's tables through the adapter, so its work grows with
the data. Doubles are rounded to 4 places at this boundary only (the
operators themselves return full precision) so the SQL oracle comparison
is immune to summation order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.context import context
from patronage.operators import clean as C
from patronage.operators import marts as MT
from patronage.operators import rfm as RF

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
HALF = 0.4999713


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            scale = float(10 ** places)
            # Quantise to 10^-places with the boundary just off the exact half:
            # values on the data's decimal grid (sums of 4-decimal prices, their
            # halves) then never straddle a boundary because of summation-order
            # noise. Same expression in the SQL oracle.
            cols.append((F.floor(F.col(f.name) * scale + HALF) / scale).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(*names: str):
    def deco(fn):
        for n in names:
            QUERIES[n] = lambda spark, sf_dir, _fn=fn: rounded(_fn(context(spark, sf_dir)))
        return fn
    return deco


# ---------------------------------------------------------------- cleaning
@register("fil1")
def _fil1(ctx):
    """Exact-duplicate removal on the raw order lines."""
    return ctx.raw["order_items"].dropDuplicates()


@register("fil2")
def _fil2(ctx):
    """Key dedup keep-first (explicit total order) on the raw order lines."""
    return C.keep_first(ctx.raw["order_items"], ["order_id", "order_item_id"],
                        ["product_id", "seller_id", "shipping_limit_date", "price", "freight_value"])


@register("fil3", "fil7", "fil8")
def _fil3(ctx):
    """Cleaned order lines: required non-null, positive price, freight clipped/filled."""
    return ctx.clean["order_items"]


@register("fil4", "fil5", "fil6")
def _fil4(ctx):
    """Cleaned orders: status, non-null timestamp, inclusive window, chronology."""
    return ctx.clean["orders"]


@register("fil9", "joi7")
def _fil9(ctx):
    return ctx.clean["products"]


@register("fil12")
def _fil12(ctx):
    return ctx.ledger.frame()


# ---------------------------------------------------------------- marts
@register("agg1")
def _agg1(ctx):
    return MT.aggregate_payments(ctx.clean["order_payments"])


@register("agg2")
def _agg2(ctx):
    return ctx.clean["order_reviews"]


@register("fil10", "fil11", "joi1", "joi2", "joi3", "joi4", "joi5", "joi6")
def _tx(ctx):
    return ctx.transactions


@register("agg3", "agg31")
def _agg3(ctx):
    return ctx.orders


# ---------------------------------------------------------------- RFM
@register("agg10")
def _agg10(ctx):
    return RF.snapshot_date(ctx.orders)


@register("agg11")
def _agg11(ctx):
    return RF.build_rfm(ctx.orders)


@register("agg12")
def _agg12(ctx):
    return RF.derive_thresholds(ctx.orders, ctx.params)


@register("rfm1")
def _rfm1(ctx):
    return RF.score_rfm(RF.build_rfm(ctx.orders), RF.derive_thresholds(ctx.orders, ctx.params))


def segmented(ctx):
    return ctx._get("segmented", lambda: RF.run_rfm(ctx.orders, ctx.params)[0])


@register("rfm2", "rfm4")
def _rfm2(ctx):
    return segmented(ctx)


@register("rfm3")
def _rfm3(ctx):
    return RF.segment_gap_check(segmented(ctx))


@register("agg14", "joi16")
def _agg14(ctx):
    return RF.segment_summary(segmented(ctx))


@register("agg13", "win2")
def _agg13(ctx):
    return RF.repurchase_curve(ctx.orders)


@register("agg15")
def _agg15(ctx):
    return RF.frequency_definition_impact(RF.build_rfm(ctx.orders))


@register("win2")
def _win2(ctx):
    """Repurchase curve over intraday purchase events (sub-day gaps exercised)."""
    return RF.repurchase_curve(ctx.purchases)


# ---------------------------------------------------------------- KPIs
from patronage.operators import cohorts as CO  # noqa: E402
from patronage.operators import metrics as ME  # noqa: E402


@register("agg4")
def _agg4(ctx):
    return ME.headline_metrics(ctx.orders)


@register("agg5", "agg6", "win1", "joi10")
def _agg5(ctx):
    return ME.monthly_trend(ctx.orders)


@register("agg7", "srt2")
def _agg7(ctx):
    return ME.category_breakdown(ctx.transactions, 15)


@register("agg8")
def _agg8(ctx):
    return ME.state_breakdown(ctx.orders)


@register("agg9")
def _agg9(ctx):
    return ME.category_monthly(ctx.transactions)


@register("agg9_totals")
def _agg9_totals(ctx):
    return ME.category_totals(ME.category_monthly(ctx.transactions))


@register("agg30")
def _agg30(ctx):
    return ME.etl_summary(ctx.transactions, ctx.orders)


# ---------------------------------------------------------------- cohorts
@register("agg16")
def _agg16(ctx):
    return CO.build_cohort_table(ctx.orders).select("order_id", "customer_unique_id", "order_month",
                                                    "cohort_month", "month_index")


@register("agg17")
def _agg17(ctx):
    return CO.cohort_sizes(ctx.orders)


@register("agg18")
def _agg18(ctx):
    return CO.retention_matrix(ctx.orders)


@register("agg19", "win4")
def _agg19(ctx):
    return CO.cumulative_repeat_matrix(ctx.orders)


@register("agg20")
def _agg20(ctx):
    return CO.cohort_revenue_matrix(ctx.orders)


@register("agg21")
def _agg21(ctx):
    return CO.cohort_summary(ctx.orders)


# ---------------------------------------------------------------- concentration
from patronage.operators import concentration as CN  # noqa: E402
from patronage.plans.joins import with_one_row  # noqa: E402
from patronage.plans.ranking import global_rank, rank_bin  # noqa: E402


@register("agg22")
def _agg22(ctx):
    return CN.top_share(RF.build_rfm(ctx.orders))


@register("agg23")
def _agg23(ctx):
    return CN.gini(RF.build_rfm(ctx.orders))


@register("rnk3")
def _rnk3(ctx):
    return CN.lorenz_curve(RF.build_rfm(ctx.orders))


@register("rnk1")
def _rnk1(ctx):
    """Global rank of customers by spend (descending, key tie-break)."""
    rfm = RF.build_rfm(ctx.orders).select("customer_unique_id", "monetary")
    return global_rank(rfm, [F.col("monetary").desc(), F.col("customer_unique_id").asc()], "rank")


@register("rnk2")
def _rnk2(ctx):
    """Quintile bins of the spend rank (qcut on ranks)."""
    r = _rnk1(ctx)
    n = r.agg(F.count(F.lit(1)).alias("n"))
    return with_one_row(r, n).withColumn("bin", rank_bin("rank", "n", 5)).drop("n")


# ---------------------------------------------------------------- panels
from patronage.operators import panel as PN  # noqa: E402
from patronage.session import materialize  # noqa: E402


def panel(ctx):
    return ctx._get("panel", lambda: materialize(PN.build_panel(ctx.orders, ctx.params)))


@register("fea1", "fea2", "fea3", "fea4", "fea5", "fea6", "set1", "fil18", "joi11", "joi12", "win5")
def _fea1(ctx):
    return panel(ctx)


@register("fea8")
def _fea8(ctx):
    return PN.align_categories(panel(ctx))


@register("fea9", "set2")
def _fea9(ctx):
    return PN.leakage_audit(ctx.orders, panel(ctx), ctx.params)


@register("fea10")
def _fea10(ctx):
    return PN.describe_panel(panel(ctx))


@register("fea11", "win3")
def _fea11(ctx):
    return PN.lifetimes_summary(ctx.orders, ctx.params.test_origin)


@register("fea12")
def _fea12(ctx):
    return PN.observed_aov(ctx.orders, ctx.params.test_origin)


# ---------------------------------------------------------------- evaluation / ROI
from patronage.operators import evaluate as EV  # noqa: E402


def spend_scores(ctx):
    """Test-origin panel scored by historical spend (MOD11): y = 90-day target, p = monetary."""
    test = panel(ctx).where(F.col("split") == "test")
    return EV.scores_long(test, "customer_unique_id", "target", {"historical_spend": "monetary"})


@register("mod11", "eva1", "eva2", "eva3", "eva4")
def _eva1(ctx):
    return EV.point_metrics(spend_scores(ctx), ctx.params.top_fraction)


@register("eva7")
def _eva7(ctx):
    return EV.quantile_calibration(spend_scores(ctx), 5)


@register("eva9")
def _eva9(ctx):
    p = panel(ctx)
    return EV.baseline_comparison(p.where(F.col("split") == "test"), p.where(F.col("split") == "train"))


def targeting(ctx):
    return EV.target_top(spend_scores(ctx), ctx.params.top_fraction)


@register("roi1", "srt4")
def _roi1(ctx):
    return targeting(ctx)


@register("roi2")
def _roi2(ctx):
    return EV.breakeven_table(targeting(ctx))


@register("roi3")
def _roi3(ctx):
    return EV.channel_grid(targeting(ctx))


@register("srt3")
def _srt3(ctx):
    """Top-200 customers by score."""
    return spend_scores(ctx).orderBy(F.col("p").desc(), F.col("key").asc()).limit(200)


@register("rnk4")
def _rnk4(ctx):
    """Percentile of each customer's score among all scores (probes = the scores)."""
    s = spend_scores(ctx)
    probes = s.select(F.col("key").cast("string").alias("probe_id"), F.col("p").alias("value"))
    return EV.score_percentile(s, probes)


@register("eva5", "eva6")
def _eva5(ctx):
    boot = EV.bootstrap_metrics(spend_scores(ctx), ctx.params.n_boot, ctx.params.seed, ctx.params.top_fraction)
    ci = EV.percentile_ci(boot)
    return ci.withColumns(EV.ci_verdicts("auc_lo", "auc_hi", 0.5, "auc"))


@register("eva10_spend")
def _eva10_spend(ctx):
    """The comparison row of the historical-spend score alone."""
    return EV.model_comparison(spend_scores(ctx), ctx.params.n_boot, ctx.params.seed, ctx.params.top_fraction)


@register("roi4_spend")
def _roi4_spend(ctx):
    """The historical-spend strategy against random targeting."""
    return EV.compare_strategies(spend_scores(ctx), ctx.params.top_fraction, ctx.params.n_boot_strategies, ctx.params.seed)


@register("eva8")
def _eva8(ctx):
    return EV.calibration_bands(spend_scores(ctx), 5, ctx.params.n_boot_bands, ctx.params.seed)


@register("roi4")
def _roi4(ctx):
    """The three targeting strategies (boosted model, BG/NBD x AOV, historical spend) and random targeting."""
    s = all_scores(ctx).where(F.col("model").isin(*STRATEGIES))
    return EV.compare_strategies(s, ctx.params.top_fraction, ctx.params.n_boot_strategies, ctx.params.seed)


# ---------------------------------------------------------------- quality
from patronage.operators import quality as QA  # noqa: E402


def report(ctx):
    return QA.run_all(ctx.clean, ctx.transactions, ctx.orders, ctx.ledger.nulls)


@register("qua9")
def _qua9(ctx):
    return report(ctx)


@register("qua1")
def _qua1(ctx):
    return reduce_union(QA.check_primary_keys(ctx.clean))


@register("qua2")
def _qua2(ctx):
    return reduce_union(QA.check_required_not_null(ctx.clean, ctx.ledger.nulls))


@register("qua3", "joi9", "set3")
def _qua3(ctx):
    return reduce_union(QA.check_referential_integrity(ctx.clean))


@register("qua4")
def _qua4(ctx):
    return reduce_union(QA.check_transaction_integrity(ctx.transactions))


@register("qua5", "qua6")
def _qua5(ctx):
    return reduce_union(QA.check_orders_reconcile(ctx.transactions, ctx.orders))


@register("qua7")
def _qua7(ctx):
    return reduce_union(QA.check_temporal_sanity(ctx.orders))


@register("qua8")
def _qua8(ctx):
    return reduce_union(QA.check_customer_identity(ctx.orders))


@register("joi8")
def _joi8(ctx):
    """Fan-out guard: order lines before vs after the four left joins."""
    items = ctx.clean["order_items"].join(ctx.clean["orders"].select("order_id", "customer_id"), "order_id") \
        .join(ctx.clean["customers"].select("customer_id"), "customer_id")
    return QA.fanout_guard(items, ctx.transactions)


def reduce_union(parts):
    from functools import reduce as _r
    return _r(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- slices
from patronage.operators import cube as CU  # noqa: E402
from patronage.operators import dashboard as DB  # noqa: E402
from patronage.operators import slices as SL  # noqa: E402

SAMPLE_FILTERS = SL.Filters(date_start="2000-01-01", date_end="2000-06-30",
                            states=("NATION_1", "NATION_2", "NATION_3"), categories=())


@register("fil13")
def _fil13(ctx):
    return SL.apply_filters(ctx.orders, SAMPLE_FILTERS)


def slice_cube(ctx):
    return ctx._get("cube", lambda: CU.build_cube(ctx.orders))


@register("agg4_slice")
def _agg4_slice(ctx):
    """Headline figures of a slice, from the cube."""
    return CU.headline(slice_cube(ctx), SAMPLE_FILTERS)


@register("agg5_slice")
def _agg5_slice(ctx):
    """Months of a slice, from the cube."""
    return CU.months(slice_cube(ctx), SAMPLE_FILTERS)


@register("agg8_slice")
def _agg8_slice(ctx):
    """States of a slice, from the cube."""
    return CU.states(slice_cube(ctx), SAMPLE_FILTERS)


@register("fil14")
def _fil14(ctx):
    return SL.filter_customers(segmented(ctx), SL.Filters(states=("NATION_1", "NATION_2"),
                                                          categories=("economy", "large")))


@register("fil15")
def _fil15(ctx):
    return SL.date_presets(ctx.orders, ("2000-01-01", "2000-03-31"))


@register("fil16")
def _fil16(ctx):
    return SL.dimension_values(ctx.orders)


@register("fil17")
def _fil17(ctx):
    return SL.lookup_customers(RF.build_rfm(ctx.orders), exact="42", prefix="13") \
        .select("customer_unique_id", "monetary", "frequency")


@register("fil17_random")
def _fil17_random(ctx):
    """The seeded random draw of one customer."""
    return SL.random_customer(RF.build_rfm(ctx.orders), ctx.params.seed) \
        .select("customer_unique_id", "monetary", "frequency")


# ---------------------------------------------------------------- dashboard
def seg_scores(ctx):
    return DB.scores_with_segments(spend_scores(ctx), segmented(ctx))


@register("agg24")
def _agg24(ctx):
    return DB.segment_shares(segmented(ctx))


@register("agg25", "joi15")
def _agg25(ctx):
    return DB.score_by_segment(seg_scores(ctx))


@register("agg26")
def _agg26(ctx):
    return DB.score_totals(spend_scores(ctx))


@register("agg27")
def _agg27(ctx):
    return DB.box_stats(seg_scores(ctx), "segment", "p")


@register("agg28")
def _agg28(ctx):
    return DB.segment_drilldown(segmented(ctx))


@register("agg29")
def _agg29(ctx):
    s = segmented(ctx)
    return DB.histogram(s, "monetary", 50, 0.99).unionByName(DB.histogram(s, "recency", 50, None))


@register("agg33")
def _agg33(ctx):
    test = panel(ctx).where(F.col("split") == "test")
    return DB.population_medians(test, list(PN.FEATURES))


# ---------------------------------------------------------------- sources / sinks
from patronage.session import scratch_path  # noqa: E402
from patronage.sources import files as FS  # noqa: E402
from patronage.sources import sinks as SK  # noqa: E402
from patronage.sources.specs import TABLES  # noqa: E402


def csv_root(ctx):
    """The canonical raw tables written once as CSV (header, quoted) under the
    shared checkpoint folder — the input format of the declared-schema scan.
    Compressed: a task's file is one task's again when read."""
    def build():
        root = scratch_path(ctx.spark, "csv-raw")
        for spec in TABLES:
            df = ctx.raw[spec.name]
            (df.write.mode("overwrite").option("header", True).option("quoteAll", True).option("compression", "gzip")
             .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(f"{root}/{spec.filename}"))
        return root
    return ctx._get("csv_root", build)


@register("src1")
def _src1(ctx):
    from patronage.sources.specs import ORDERS
    return FS.load_table(ctx.spark, ORDERS, csv_root(ctx), "csv")


@register("src2")
def _src2(ctx):
    tables = FS.load_all(ctx.spark, csv_root(ctx), "csv", register_views=True)
    parts = [ctx.spark.sql(f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {name}") for name in tables]
    return reduce_union(parts)


@register("src3")
def _src3(ctx):
    raw = {k: v for k, v in ctx.raw.items()}
    pks = {s.name: s.primary_key for s in TABLES}
    return FS.profile(raw, pks)


@register("src4")
def _src4(ctx):
    """Parquet scan: the filter and the 3-column projection reach the scan
    (PushedFilters / ReadSchema)."""
    return FS.read_parquet(ctx.spark, f"{ctx.sf_dir}/orders.parquet") \
        .where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_orderdate")


@register("snk1")
def _snk1(ctx):
    """Marts written to a staging folder, partitioned by month, and published
    only when the quality report has no FAIL; returns the published order mart."""
    root = scratch_path(ctx.spark, "marts")
    ok = SK.publish_if_clean(ctx.spark, {"orders": ctx.orders, "transactions": ctx.transactions}, report(ctx), root)
    if not ok:
        raise RuntimeError("quality report has FAIL rows; marts left in staging")
    return SK.published(ctx.spark, root, "orders")


@register("snk1_analytics")
def _snk1_analytics(ctx):
    """Every table of the analytics run (segments, summaries, cohort matrices,
    exports) written and published; returns their sizes, read back."""
    from patronage.runs import run_analytics
    tables = run_analytics(ctx.transactions, ctx.orders, ctx.params, scratch_path(ctx.spark, "analytics"))
    return reduce_union([df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
                         for name, df in tables.items()])


@register("agg11_by_customer")
def _agg11_by_customer(ctx):
    """RFM values from the order mart laid out by customer (no exchange on the customer)."""
    return RF.build_rfm(ctx.customer_orders)


@register("agg16_by_customer")
def _agg16_by_customer(ctx):
    """Orders with their cohorts from the order mart laid out by customer."""
    return CO.build_cohort_table(ctx.customer_orders).select("order_id", "customer_unique_id", "order_month",
                                                             "cohort_month", "month_index")


@register("fea11_by_customer")
def _fea11_by_customer(ctx):
    """Lifetime summary from the order mart laid out by customer."""
    return PN.lifetimes_summary(ctx.customer_orders, ctx.params.test_origin)


@register("snk2")
def _snk2(ctx):
    return SK.shrink(ctx.orders, SK.ORDER_COLS)


@register("snk3")
def _snk3(ctx):
    return SK.meta_table(ctx.orders, RF.derive_thresholds(ctx.orders, ctx.params), RF.snapshot_date(ctx.orders))


# ---------------------------------------------------------------- models
from patronage.operators import models as MD  # noqa: E402

STRATEGIES = EV.STRATEGIES


def prob_fit(ctx):
    return ctx._get("prob_fit", lambda: MD.fit_probabilistic(ctx.orders, ctx.params.test_origin,
                                                             ctx.params.horizon_days))


def split(ctx, name):
    return panel(ctx).where(F.col("split") == name)


def glm_model(ctx):
    return ctx._get("glm", lambda: MD.fit_tweedie_glm(split(ctx, "train")))


def boosted(ctx, loss):
    return ctx._get("boosted", lambda: MD.fit_boosted(split(ctx, "train"), split(ctx, "valid")))[loss]


@register("mod1", "mod3")
def _mod1(ctx):
    return prob_fit(ctx).params_frame(ctx.spark)


@register("mod2", "mod5", "joi17")
def _mod2(ctx):
    return prob_fit(ctx).predictions


@register("mod4")
def _mod4(ctx):
    f = prob_fit(ctx)
    return ctx.spark.createDataFrame([(f.params.get("gg_q"), f.gg_valid, f.note)],
                                     "gg_q double, gg_valid boolean, note string")


@register("mod6")
def _mod6(ctx):
    return prob_fit(ctx).diagnostics


#: Parameters as a caller may have them from an earlier fit; SQL can state what follows from them.
GIVEN = {"r": 0.8, "alpha": 150.0, "a": 1.7, "b": 2.5, "gg_p": 6.0, "gg_q": 0.7, "gg_v": 1500.0}


def given_predictions(ctx):
    return ctx._get("given", lambda: materialize(MD.predictions(
        PN.lifetimes_summary(ctx.orders, ctx.params.test_origin), ctx.orders, ctx.params.test_origin, GIVEN,
        MD.mean_spend(GIVEN["gg_p"], GIVEN["gg_q"], GIVEN["gg_v"]), ctx.params.horizon_days)))


@register("mod2_given", "mod5_given", "joi17_given")
def _mod2_given(ctx):
    """Expected purchases, values and both predictions under given parameters."""
    return given_predictions(ctx)


@register("mod6_given", "mod4_given")
def _mod6_given(ctx):
    """Diagnostics and validity note under given parameters."""
    return MD.diagnostics(given_predictions(ctx), MD.mean_spend_status(GIVEN["gg_q"])[1])


@register("joi13_given", "joi14_given")
def _joi13_given(ctx):
    """Given predictions of some of the customers aligned to the test panel (missing → 0), with the features."""
    preds = given_predictions(ctx).where(F.pmod("customer_unique_id", F.lit(3)) != 0) \
        .select("customer_unique_id", "pred_bgnbd", "pred_bgnbd_empirical")
    return DB.aligned_scores(split(ctx, "test").withColumnRenamed("target", "actual_90d_spend"), preds) \
        .select("customer_unique_id", "actual_90d_spend", "pred_bgnbd", "pred_bgnbd_empirical", "recency", "frequency",
                "monetary", "tenure", "aov", "customer_state", "top_category")


@register("agg32")
def _agg32(ctx):
    return MD.gamma_gamma_assumption(PN.lifetimes_summary(ctx.orders, ctx.params.test_origin))


def model_scores(ctx):
    """JOI13 + JOI14: every model's test-origin prediction aligned to the test
    panel (missing → 0), with the features."""
    def build():
        test = split(ctx, "test")
        gbm = boosted(ctx, "tweedie").transform(test, "pred_gbm").select("customer_unique_id", "pred_gbm")
        l2 = boosted(ctx, "squared").transform(test, "pred_gbt_l2").select("customer_unique_id", "pred_gbt_l2")
        pb = prob_fit(ctx).predictions.select("customer_unique_id", "pred_bgnbd", "pred_bgnbd_empirical")
        preds = gbm.join(l2, "customer_unique_id", "full").join(pb, "customer_unique_id", "full")
        return materialize(DB.aligned_scores(test.withColumnRenamed("target", "actual_90d_spend"), preds))
    return ctx._get("model_scores", build)


@register("mod7", "joi13", "joi14")
def _mod7(ctx):
    return model_scores(ctx)


@register("mod8")
def _mod8(ctx):
    return model_scores(ctx).select("customer_unique_id", "actual_90d_spend", "pred_gbt_l2") \
        .withColumn("rounds", F.lit(boosted(ctx, "squared").rounds))


@register("mod7_glm")
def _mod7_glm(ctx):
    """The linear companion of the boosted model, on the test origin."""
    return glm_model(ctx).transform(split(ctx, "test"), "pred_glm").select("customer_unique_id", "pred_glm")


@register("mod9", "srt5")
def _mod9(ctx):
    return MD.feature_importances(ctx.spark, boosted(ctx, "tweedie"))


def all_scores(ctx):
    return EV.scores_long(model_scores(ctx), "customer_unique_id", "actual_90d_spend", EV.MODELS)


@register("eva7_models")
def _eva7_models(ctx):
    return EV.quantile_calibration(all_scores(ctx))


@register("roi1_models")
def _roi1_models(ctx):
    return EV.target_top(all_scores(ctx), ctx.params.top_fraction)


@register("snk2_scores")
def _snk2_scores(ctx):
    """Slim export of the score table."""
    return SK.shrink(model_scores(ctx), SK.CLV_COLS)


@register("eva10")
def _eva10(ctx):
    return EV.model_comparison(all_scores(ctx), ctx.params.n_boot, ctx.params.seed, ctx.params.top_fraction)


@register("mod10")
def _mod10(ctx):
    """What-if: hypothetical profiles on top of the population medians,
    scored by the boosted Tweedie model, with the percentile among test scores."""
    test = split(ctx, "test")
    med = DB.population_medians(test, list(PN.FEATURES))
    base = med.withColumns({"top_category": F.lit(None).cast("string"), "customer_state": F.lit(None).cast("string"),
                            "payment_type": F.lit(None).cast("string")})
    profiles = [("median customer", {}),
                ("recent repeat buyer", {"recency": 30.0, "frequency": 2.0, "n_orders": 2.0, "is_repeat": 1.0}),
                ("lapsed one-timer", {"recency": 400.0, "tenure": 400.0, "frequency": 1.0, "is_repeat": 0.0})]
    parts = []
    for name, over in profiles:
        parts.append(base.withColumns({k: F.lit(v) for k, v in over.items()}).withColumn("profile", F.lit(name)))
    prof = reduce_union(parts).where(F.col("tenure") >= F.col("recency"))   # reject impossible profiles
    cast = {c: F.col(c).cast(test.schema[c].dataType) for c in PN.FEATURES}
    scored = boosted(ctx, "tweedie").transform(prof.withColumns(cast), "score")
    scores = model_scores(ctx).select(F.col("pred_gbm").alias("p"))
    pct = EV.score_percentile(scores, scored.select(F.col("profile").alias("probe_id"), F.col("score").alias("value")))
    return pct.withColumnRenamed("probe_id", "profile")


@register("snk4")
def _snk4(ctx):
    """Model bundle: the boosted models as tables (settings, features, nodes),
    the probabilistic parameters and diagnostics, evaluation with intervals,
    calibration, targeting, break-even, channel and strategy tables, leakage
    summary and importances, written under the shared folder; returns for each of
    its tables, read back, rows, columns and a digest that does not depend on
    the order of rows."""
    root = scratch_path(ctx.spark, f"bundle-{uuid.uuid4().hex}")
    model, scores, prob = boosted(ctx, "tweedie"), all_scores(ctx), prob_fit(ctx)
    best = scores.where(F.col("model") == STRATEGIES[0])
    top = EV.target_top(best, ctx.params.top_fraction)
    tables = {
        "params": prob.params_frame(ctx.spark), "diagnostics": prob.diagnostics,
        **{f"{n}_{t}": df for n in ("tweedie", "squared") for t, df in boosted(ctx, n).tables(ctx.spark).items()},
        "evaluation": EV.model_comparison(scores, ctx.params.n_boot, ctx.params.seed, ctx.params.top_fraction),
        "calibration": EV.quantile_calibration(scores), "targeting": top, "breakeven": EV.breakeven_table(top),
        "channels": EV.channel_grid(top),
        "strategies": EV.compare_strategies(scores.where(F.col("model").isin(*STRATEGIES)), ctx.params.top_fraction,
                                            ctx.params.n_boot_strategies, ctx.params.seed),
        "leakage": PN.leakage_audit(ctx.orders, panel(ctx), ctx.params),
        "importances": MD.feature_importances(ctx.spark, model),
    }
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
    return reduce_union([SK.contents(ctx.spark.read.parquet(f"{root}/{name}"), name) for name in tables])


@register("fea7")
def _fea7(ctx):
    return PN.window_schedule(ctx.orders, ctx.params)


@register("srt1")
def _srt1(ctx):
    """The order-line mart in its documented order (a range-partitioned global sort)."""
    return ctx.transactions.orderBy("order_purchase_timestamp", "order_id", "order_item_id")
