"""The three entry points of the reference's lifecycle, as compositions of
operators: ETL, analytics (+ dashboard exports), training/evaluation.

Each returns lazily-built DataFrames (plus small driver-side objects such as
fitted parameters); writes go to the given folder. Nothing here collects data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.config import MAX_ROUNDS, Params
from patronage.operators import cohorts as CO
from patronage.operators import evaluate as EV
from patronage.operators import metrics as ME
from patronage.operators import models as MD
from patronage.operators import panel as PN
from patronage.operators import quality as QA
from patronage.operators import rfm as RF
from patronage.operators.dashboard import aligned_scores
from patronage.operators.marts import build_marts
from patronage.session import materialize
from patronage.sources import sinks as SK


@dataclass
class EtlResult:
    clean: dict[str, DataFrame]
    transactions: DataFrame
    orders: DataFrame
    report: DataFrame
    ledger: DataFrame
    summary: DataFrame
    published: bool | None


def run_etl(spark: SparkSession, raw: dict[str, DataFrame], params: Params, out_root: str | None = None) -> EtlResult:
    """Clean (with ledger) → marts → quality report → staged publish."""
    clean, tx, orders, led = build_marts(raw, params)
    report = QA.run_all(clean, tx, orders, led.nulls)
    published = None
    if out_root:
        published = SK.publish_if_clean(spark, {"orders": orders, "transactions": tx}, report, out_root)
    return EtlResult(clean, tx, orders, report, led.frame(), ME.etl_summary(tx, orders), published)


def run_analytics(transactions: DataFrame, orders: DataFrame, params: Params,
                  out_root: str | None = None) -> dict[str, DataFrame]:
    """KPIs, repurchase curve, RFM (table, thresholds, segments, summary),
    frequency-definition impact, cohort matrices and the dashboard exports;
    written and published under ``out_root`` if that is given."""
    segmented, summary, th = RF.run_rfm(orders, params)
    tables = {
        "kpis": ME.headline_metrics(orders),
        "monthly_trend": ME.monthly_trend(orders),
        "categories": ME.category_breakdown(transactions),
        "states": ME.state_breakdown(orders),
        "category_monthly": ME.category_monthly(transactions),
        "repurchase_curve": RF.repurchase_curve(orders),
        "segments": segmented,
        "segment_summary": summary,
        "thresholds": th,
        "frequency_impact": RF.frequency_definition_impact(RF.build_rfm(orders)),
        "cohort_sizes": CO.cohort_sizes(orders),
        "cohort_retention": CO.retention_matrix(orders),
        "cohort_cumulative": CO.cumulative_repeat_matrix(orders),
        "cohort_revenue": CO.cohort_revenue_matrix(orders),
        "cohort_summary": CO.cohort_summary(orders),
        "export_orders": SK.shrink(orders, SK.ORDER_COLS),
        "export_segments": SK.shrink(segmented, SK.RFM_COLS),
        "meta": SK.meta_table(orders, th, RF.snapshot_date(orders)),
    }
    if not out_root:
        return tables
    spark = orders.sparkSession
    SK.publish(spark, tables, out_root)
    return {name: SK.published(spark, out_root, name) for name in tables}


def run_training(orders: DataFrame, params: Params, max_rounds: int = MAX_ROUNDS, out_root: str | None = None) -> dict:
    """Leakage audit → panels → probabilistic and regression models →
    evaluation with bootstrap CIs → calibration → ROI tables. The score table,
    its slim export, the importances and the predictions of the probabilistic
    model are published under ``out_root`` if that is given."""
    panel = materialize(PN.build_panel(orders, params))
    split = lambda s: panel.where(F.col("split") == s)
    audit = PN.leakage_audit(orders, panel, params)
    prob = MD.fit_probabilistic(orders, params.test_origin, params.horizon_days)
    valid = split("valid") if params.valid_origin else None
    gbm, l2 = MD.fit_boosted(split("train"), valid, max_rounds=max_rounds).values()
    test = split("test")
    preds = (gbm.transform(test, "pred_gbm").select("customer_unique_id", "pred_gbm")
             .join(l2.transform(test, "pred_gbt_l2").select("customer_unique_id", "pred_gbt_l2"), "customer_unique_id", "full")
             .join(prob.predictions.select("customer_unique_id", "pred_bgnbd", "pred_bgnbd_empirical"),
                   "customer_unique_id", "full"))
    scores = materialize(aligned_scores(test.withColumnRenamed("target", "actual_90d_spend"), preds))
    long = EV.scores_long(scores, "customer_unique_id", "actual_90d_spend", EV.MODELS)
    targeting = EV.target_top(long.where(F.col("model") == EV.STRATEGIES[0]), params.top_fraction)
    out = {
        "panel": panel, "panel_description": PN.describe_panel(panel), "leakage_audit": audit,
        "probabilistic": prob, "rounds": {"tweedie": gbm.rounds, "squared": l2.rounds}, "scores": scores,
        "export_scores": SK.shrink(scores, SK.CLV_COLS),
        "baselines": EV.baseline_comparison(test, split("train")),
        "comparison": EV.model_comparison(long, params.n_boot, params.seed, params.top_fraction),
        "calibration": EV.quantile_calibration(long),
        "importances": MD.feature_importances(orders.sparkSession, gbm),
        "targeting": targeting, "breakeven": EV.breakeven_table(targeting), "channels": EV.channel_grid(targeting),
        "strategies": EV.compare_strategies(long.where(F.col("model").isin(*EV.STRATEGIES)), params.top_fraction,
                                            params.n_boot_strategies, params.seed),
    }
    if out_root:
        written = {name: out[name] for name in ("scores", "export_scores", "importances")}
        SK.publish(orders.sparkSession, {**written, "probabilistic": prob.predictions}, out_root)
    return out
